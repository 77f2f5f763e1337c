from __future__ import annotations

import random

import pytest
from samples import bare_line, line, upstream_line

from tallyweir.operators.metrics import METRICS, metric, metrics_wide
from tallyweir.operators.partials import add_up, line_counts, partial_metrics, skip_counts
from tallyweir.operators.points import points_from_partials
from tallyweir.operators.requests import parse_lines
from tallyweir.sources.scratch import written


def values(frame, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r["value"] for r in frame.collect()}


def points_of(lines, duration=60):
    partials = written(partial_metrics(lines, duration), "test-partials")
    return {
        (r.measurement, r.bucket, r.vhost, r.protocol, r.loctag, r.upstream, r.status): (
            r.value_i if r.value_d is None else r.value_d
        )
        for r in points_from_partials(partials, duration).collect()
    }


def test_repeated_contacts_are_weighted(lines_of):
    lines = lines_of(
        upstream_line("A, A", "502, 200", "1.0, 2.0", "-, -", "-, -"), upstream_line("A", "200", "10.0", "-", "-")
    )
    assert values(metric(lines, "upstreams_hits"), "upstream") == {"A": 3}
    assert values(metric(lines, "upstreams_response_time_mean"), "upstream") == {"A": 3.2}
    assert values(metric(lines, "upstreams_status"), "status") == {"200": 3, "502": 2}
    assert metric(lines, "upstreams_connect_time_mean").count() == 0


def test_per_contact_weighting(lines_of):
    lines = lines_of(
        upstream_line("A, A", "502, 200", "1.0, 2.0", "-, -", "-, -"), upstream_line("A", "200", "10.0", "-", "-")
    )
    mean = metric(lines, "upstreams_response_time_mean", weighting="per_contact").first()["value"]
    assert mean == pytest.approx(13 / 3)
    assert values(metric(lines, "upstreams_status", weighting="per_contact"), "status") == {"200": 2, "502": 1}
    with pytest.raises(ValueError):
        metric(lines, "upstreams_hits", weighting="other")


def test_same_status_twice_counts_once_per_contact(lines_of):
    # three contacts of A with statuses 200, 0200 and 500: each distinct status gets all three
    lines = lines_of(upstream_line("A, A, B, A", "200, 0200, 200, 500", "1, 1, 1, 1", "1, 1, 1, 1", "1, 1, 1, 1"))
    assert values(metric(lines, "upstreams_status"), "upstream", "status") == {
        ("A", "200"): 3,
        ("A", "500"): 3,
        ("B", "200"): 1,
    }
    assert values(metric(lines, "upstreams_hits"), "upstream") == {"A": 3, "B": 1}


def test_zero_rows_of_gzip_count(lines_of):
    with_gzip = line(vhost="a")
    without = line(vhost="b", gzip_ratio="-")
    assert values(metric(lines_of(with_gzip, without), "gzip_count"), "vhost") == {"a": 1, "b": 0}
    assert values(metric(lines_of(without), "gzip_count"), "vhost") == {}
    percent = metric(lines_of(with_gzip, with_gzip, line(vhost="a", gzip_ratio="-"), without), "gzip_count_percent")
    assert values(percent, "vhost") == {"a": pytest.approx(2 / 3), "b": 0.0}


def test_zero_rows_are_decided_per_source(lines_of):
    lines = lines_of(("x", line(vhost="a")), ("x", line(vhost="b", gzip_ratio="-")), ("y", line(gzip_ratio="-")))
    assert values(metric(lines, "gzip_count"), "source", "vhost") == {("x", "a"): 1, ("x", "b"): 0}
    points = points_of(lines)
    assert sorted(v for k, v in points.items() if k[0] == "gzip_count") == [0, 1]


def test_request_length_mean_is_cut(lines_of):
    lines = lines_of(*[bare_line("100", request_length=n) for n in (289, 290, 290, 290, 290, 290, 290, 290, 289, 289)])
    row = metric(lines, "request_length_mean").first()
    assert row["value"] == 289


def test_missing_request_times_count_in_no_mean(lines_of):
    lines = lines_of(bare_line("100", request_time="1.0"), bare_line("100", request_time="-"))
    assert metric(lines, "request_time_mean").first()["value"] == 1.0
    assert metric(lines_of(bare_line("100", request_time="-")), "request_time_mean").count() == 0


def test_protocols_group_by_their_label(lines_of):
    lines = lines_of(bare_line("100", protocol="s"), bare_line("100", protocol="-"), bare_line("100", protocol="x"))
    assert values(metric(lines, "hits"), "protocol") == {"https": 1, "http": 2}


def quarter_hour():
    """Lines at hand-picked seconds, in buckets of 30 s: three servers, one that never tells a header time."""
    told = [  # second, status, server, header time
        (3, "200", "east", "0.010"),
        (29, "404", "east", "0.020"),
        (30, "200", "west", "0.005"),
        (31, "200", "mute", "-"),
        (59, "500", "mute", "-"),
        (60, "200", "east", "0.030"),
        (61, "200", "mute", "-"),
        (61, "200", "west", "bad"),
        (89, "404", "west", "0.001"),
    ]
    return [upstream_line(server, header=header, msec=f"{second}.0").replace("|ws|200|", f"|ws|{status}|") for second, status, server, header in told]


def test_a_few_buckets_by_hand(lines_of):
    lines = lines_of(*quarter_hour())
    assert values(metric(lines, "hits", 30), "bucket") == {1: 3, 2: 3, 3: 2}
    assert values(metric(lines, "bytes_sent", 30), "bucket") == {b: 2799 * n for b, n in ((1, 3), (2, 3), (3, 2))}
    status = values(metric(lines, "status", 30), "bucket", "status")
    assert status == {(1, "200"): 2, (1, "404"): 1, (2, "200"): 2, (2, "500"): 1, (3, "200"): 1, (3, "404"): 1}
    header = values(metric(lines, "upstreams_header_time_mean", 30), "bucket", "upstream")
    # the server whose header times are all absent has no mean, though it has hits
    assert header == {(1, "east"): 0.015, (1, "west"): 0.005, (2, "east"): 0.03, (3, "west"): 0.001}
    hits = values(metric(lines, "upstreams_hits", 30), "bucket", "upstream")
    assert hits == {(1, "east"): 2, (1, "west"): 1, (2, "east"): 1, (2, "mute"): 2, (3, "mute"): 1, (3, "west"): 1}


def random_lines(seed, n=300):
    rng = random.Random(seed)
    servers = ["A", "B", "C"]
    out = []
    for _ in range(n):
        k = rng.randint(1, 4)
        joints = [rng.choice([", ", " : "]) for _ in range(k - 1)]

        def listed(choices, k=k, joints=joints):
            entries = [rng.choice(choices) for _ in range(k)]
            return entries[0] + "".join(j + e for j, e in zip(joints, entries[1:]))

        out.append(
            line(
                msec=f"{rng.uniform(1, 600):.3f}",
                vhost=rng.choice(["a", "b"]),
                protocol=rng.choice(["s", "-"]),
                status=rng.choice(["200", "302", "x"]),
                gzip_ratio=rng.choice(["-", "1.5", "2.25"]),
                request_time=rng.choice(["-", "0.010", "0.5"]),
                upstream_addr=rng.choice(["-", listed(servers), listed(servers)]),
                upstream_status=listed(["200", "0200", "502", "-"]),
                upstream_response_time=listed(["0.001", "0.25", "-", ""]),
                upstream_connect_time=listed(["0.001", "-"]),
                upstream_header_time=rng.choice([listed(["0.1", "-"]), "0.1", "-"]),
            )
        )
    return out


def brute_force(lines, duration=60):
    """The seventeen metrics by plain loops over requests and their contacts."""

    def cut(text):
        return [e for group in text.split(", ") for e in group.split(" : ")]

    sums, any_gzip = {}, False

    def add(name, key, value):
        sums.setdefault(name, {}).setdefault(key, []).append(value)

    for text in lines:
        f = text.split("|")
        if f[5] == "x":
            continue
        key = (-(-float(f[1]) // duration), f[2], "https" if f[3] == "s" else "http", f[4])
        add("hits", key, 1)
        add("bytes_sent", key, int(f[6]))
        add("length", key, int(f[8]))
        add("status", (*key, None, f[5]), 1)
        if f[7] != "-":
            any_gzip = True
            add("gzip", key, float(f[7]))
        if f[9] != "-":
            add("time", key, float(f[9]))
        if f[10] == "-":
            continue
        contacts = list(zip(*(cut(f[i]) for i in range(10, 15))))
        add("upstreamed", key, 1)
        add("contacted", key, len(f[10].split(", ")))
        add("redirects", key, sum(" : " in g for g in f[10].split(", ")))
        add("servers", key, len(contacts))
        for server in {c[0] for c in contacts}:
            own = [c for c in contacts if c[0] == server]
            up = (*key, server, None)
            add("upstreams_hits", up, len(own))
            for name, i in (("response", 2), ("connect", 3), ("header", 4)):
                for c in own:
                    if c[i] not in ("-", ""):
                        add(name, up, (len(own), float(c[i])))
            for status in {c[1] if c[1] == "-" else str(int(c[1])) for c in own}:
                add("upstreams_status", (*key, server, status), len(own))
    out = {}

    def put(name, key, value):
        out[(name, *key, *([None, None] if len(key) == 4 else []))] = value

    for key, hits in sums["hits"].items():
        gzip, times = sums["gzip"].get(key, []), sums["time"].get(key, [])
        put("hits", key, len(hits))
        put("bytes_sent", key, sum(sums["bytes_sent"][key]))
        put("request_length_mean", key, sum(sums["length"][key]) // len(hits))
        put("gzip_count_percent", key, len(gzip) / len(hits))
        if any_gzip:
            put("gzip_count", key, len(gzip))
        if gzip:
            put("gzip_ratio_mean", key, sum(gzip) / len(gzip))
        if times:
            put("request_time_mean", key, sum(times) / len(times))
        up = len(sums["upstreamed"].get(key, []))
        if up:
            put("hits_with_upstream", key, up)
            put("upstreams_servers", key, sum(sums["servers"][key]))
            put("upstreams_servers_contacted_per_hit", key, sum(sums["contacted"][key]) / up)
            put("upstreams_internal_redirects_per_hit", key, sum(sums["redirects"][key]) / up)
    for name in ("status", "upstreams_hits", "upstreams_status"):
        for key, counts in sums[name].items():
            put(name, key, sum(counts))
    for name in ("response", "connect", "header"):
        for key, pairs in sums[name].items():
            put(f"upstreams_{name}_time_mean", key, sum(n * t for n, t in pairs) / sum(n for n, _ in pairs))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_points_equal_brute_force(lines_of, seed):
    lines = random_lines(seed)
    want = brute_force(lines)
    got = points_of(lines_of(*lines))
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value), key
    assert {k[0] for k in got} == set(METRICS)


def test_single_metrics_equal_the_points(lines_of):
    lines = lines_of(*random_lines(3))
    points = points_of(lines)
    for name in METRICS:
        single = {}
        for r in metric(lines, name).collect():
            tags = r.asDict()
            single[
                (name, r.bucket, r.vhost, r.protocol, r.loctag, tags.get("upstream"), tags.get("status"))
            ] = r.value
        assert single == {k: v for k, v in points.items() if k[0] == name}, name


def test_order_and_partitioning_do_not_matter(spark, lines_of):
    lines = random_lines(4)
    shuffled = lines[:]
    random.Random(0).shuffle(shuffled)
    one = partial_metrics(lines_of(*lines).coalesce(1)).collect()
    other = partial_metrics(lines_of(*shuffled).repartition(7)).collect()
    assert sorted(map(str, one)) == sorted(map(str, other))


def test_partials_of_parts_add_up(lines_of):
    lines = random_lines(5)
    whole = partial_metrics(lines_of(*lines))
    parts = partial_metrics(lines_of(*lines[:100])).unionByName(partial_metrics(lines_of(*lines[100:])))
    assert sorted(map(str, add_up(parts).collect())) == sorted(map(str, whole.collect()))


def test_line_and_skip_counts(lines_of):
    partials = partial_metrics(lines_of(line(), line(status="x"), line(status="y"), "", upstream_line("A, B", "1, 2")))
    assert line_counts(partials).collect()[0][1:] == (5, 3)
    assert {r.reason: r.lines for r in skip_counts(partials).collect()} == {"bad_status": 2, "bad_version": 1}


def test_wide_metrics(lines_of):
    partials = written(partial_metrics(lines_of(line(), line(gzip_ratio="-", bytes_sent=1))), "test-wide")
    row = metrics_wide(partials).collect()[0]
    assert (row.hits, row.bytes_sent, row.gzip_count, row.gzip_count_percent) == (2, 2800, 1, 0.5)
    assert (row.gzip_ratio_mean, row.request_length_mean, row.upstreams_servers) == (2.5, 289, 2)


def test_the_parse_runs_once(spark, lines_of):
    """No filter carries a second copy of the parse, and lines are shuffled once, already added up."""
    for frame in (partial_metrics(lines_of(line())), metric(lines_of(line()), "upstreams_hits")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("transform(slice(") == 1
        assert "Filter" not in plan.split("Aggregate")[-1]
    plan = partial_metrics(lines_of(line()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan.split("Exchange")[1]
    assert "Python" not in plan
    assert parse_lines(lines_of(line()))._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_neither_stop_nor_wrap(spark, lines_of, ansi):
    most = 2**63 - 1
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = lines_of(
            *[upstream_line("A, A", "200, 200", "9e12, 9e12", "-, -", "-, -", msec="50", bytes_sent=str(most), request_time="9e12")] * 3,
            bare_line("500", bytes_sent="7"),
        )
        points = points_of(lines, 60)
        of = lambda name, bucket: next(v for k, v in points.items() if k[0] == name and k[1] == bucket)
        assert of("bytes_sent", 1) == 3.0 * most and of("bytes_sent", 9) == 7
        assert of("request_time_mean", 1) == 9e12 and of("upstreams_response_time_mean", 1) == 9e12
        assert int(metric(lines, "bytes_sent").where("bucket = 1").first()["value"]) == 3 * most
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
