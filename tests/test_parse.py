from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from samples import line, upstream_line

from tallyweir.operators.contacts import contact_rows, request_summary
from tallyweir.operators.requests import REJECT_REASONS, accepted, parse_lines, rejected


def parse_one(lines_of, text, **options):
    rows = parse_lines(lines_of(text), **options).collect()
    assert len(rows) == 1
    return rows[0]


def test_one_upstream(lines_of):
    row = parse_one(lines_of, line(), bucket_duration=1)
    assert row.reason is None
    assert (row.vhost, row.protocol, row.loctag) == ("www.example.org", "s", "ws")
    assert (row.status, row.bytes_sent, row.request_length) == (200, 2799, 289)
    assert (row.gzip_ratio, row.request_time, row.msec) == (2.5, 0.026, 1568962563.374)
    assert row.bucket == 1568962564
    assert (row.servers_contacted, row.internal_redirects, row.upstreams_servers) == (1, 0, 1)


def test_several_upstreams(spark, lines_of):
    text = upstream_line(
        "192.0.2.1:8081, 192.0.2.2:8081, 192.0.2.3:8081, named",
        "502, 502, 502, 502",
        "0.000, 0.000, 0.000, 0.000",
        "0.000, 0.000, 0.000, -",
        "-, -, -, -",
        gzip_ratio="-",
    )
    requests = accepted(parse_lines(lines_of(text)))
    row = requests.first()
    assert (row.servers_contacted, row.internal_redirects, row.gzip_ratio) == (4, 0, None)
    contacts = contact_rows(requests).orderBy("position").collect()
    assert [c.server for c in contacts] == ["192.0.2.1:8081", "192.0.2.2:8081", "192.0.2.3:8081", "named"]
    assert {c.status for c in contacts} == {"502"}
    assert [c.connect for c in contacts] == [0.0, 0.0, 0.0, None]
    assert [c.header for c in contacts] == [None] * 4
    summary = {r.server: r for r in request_summary(requests).collect()}
    assert (summary["named"].response_n, summary["named"].connect_n, summary["named"].header_n) == (1, 0, 0)


def test_summary_of_a_repeated_server(lines_of):
    text = upstream_line("A, B, A", "502, 0200, 502", "1.0, 5.0, 2.0", "-, 0.1, 0.5", ", -, 0.25")
    rows = {r.server: r for r in request_summary(accepted(parse_lines(lines_of(text)))).collect()}
    a = rows["A"]
    assert (a.n, a.response_us, a.response_n, a.connect_us, a.connect_n) == (2, 3_000_000, 2, 500_000, 1)
    assert (a.header_us, a.header_n) == (250_000, 1)
    assert [(s.status, s.n) for s in a.statuses] == [("502", 2)]
    assert [(s.status, s.n) for s in rows["B"].statuses] == [("200", 1)]


@pytest.mark.parametrize(
    ("addresses", "contacted", "redirects"),
    [
        ("A", 1, 0),
        ("A, B", 2, 0),
        ("A : B", 1, 1),
        ("A : B : C", 1, 1),
        ("A, B : C, D, E : F", 4, 2),
        ("a, : b", 2, 0),
        ("a,  : b", 2, 1),
    ],
)
def test_groups_and_redirects(lines_of, addresses, contacted, redirects):
    row = parse_one(lines_of, upstream_line(addresses))
    assert (row.servers_contacted, row.internal_redirects) == (contacted, redirects)


def test_lists_are_cut_to_the_shortest(lines_of):
    # the second response time is no number, but its position is cut off
    parsed = parse_lines(lines_of(upstream_line("X : Y", "200", "0.1, bad", "0.1 : 0.2")))
    assert parsed.first().reason is None
    contacts = contact_rows(accepted(parsed)).collect()
    assert [(c.server, c.response) for c in contacts] == [("X", 0.1)]
    assert parsed.first().servers_contacted == 1


def test_paired_redirect(lines_of):
    parsed = parse_lines(lines_of(upstream_line("X : Y", "200 : 302", "0.1 : 0.2", "0 : 0", "1 : 2")))
    contacts = contact_rows(accepted(parsed)).orderBy("position").collect()
    assert [(c.server, c.status, c.header) for c in contacts] == [("X", "200", 1.0), ("Y", "302", 2.0)]


def test_no_upstream_leaves_the_other_lists_unread(lines_of):
    row = parse_one(lines_of, upstream_line("-", "xxx", "xxx", "xxx", "xxx"))
    assert (row.reason, row.contacts, row.servers_contacted, row.upstreams_servers) == (None, None, None, None)


def test_null_markers(lines_of):
    parsed = parse_lines(lines_of(upstream_line("A", "-", "0.5", "", "-", gzip_ratio="-", request_time="-")))
    row = parsed.first()
    assert (row.reason, row.gzip_ratio, row.request_time) == (None, None, None)
    contact = contact_rows(accepted(parsed)).first()
    assert (contact.status, contact.response, contact.connect, contact.header) == ("-", 0.5, None, None)


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (line(version="xxx"), "bad_version"),
        (line(version="2", msec="xxx"), "bad_version"),
        ("", "bad_version"),
        (line(msec="xxx"), "bad_msec"),
        (line(msec="nan"), "bad_msec"),
        (line(msec="inf"), "bad_msec"),
        (line(msec="1e300"), "bad_msec"),
        (line(msec="0"), "late"),
        (line(msec="-5", status="x"), "late"),
        ("1|1568962563.374|www.example.org|s", "short_line"),
        ("1", "short_line"),
        (line(status="xxx"), "bad_status"),
        (line(status="20.5"), "bad_status"),
        (line(status=""), "bad_status"),
        (line(bytes_sent="xxx", request_length="xxx"), "bad_bytes_sent"),
        (line(bytes_sent="9" * 31), "bad_bytes_sent"),
        (line(request_length="xxx"), "bad_request_length"),
        (line(gzip_ratio="xxx"), "bad_gzip_ratio"),
        (line(gzip_ratio="1.5d"), "bad_gzip_ratio"),
        (line(gzip_ratio=""), "bad_gzip_ratio"),
        (line(request_time="xxx"), "bad_request_time"),
        (line(request_time="1e25"), "bad_request_time"),
        (line(request_length="1" + "0" * 30), "bad_request_length"),
        (line(msec="253402300800"), "bad_msec"),
        (upstream_line("A", status="xxx"), "bad_upstream"),
        (upstream_line("A", status=""), "bad_upstream"),
        (upstream_line("A", status="20x"), "bad_upstream"),
        (upstream_line("A", response="x0.024"), "bad_upstream"),
        (upstream_line("A", connect="x0.000"), "bad_upstream"),
        (upstream_line("A", header="x0.024"), "bad_upstream"),
        (upstream_line("A", response=" "), "bad_upstream"),
        (upstream_line("A", response="1e300"), "bad_upstream"),
        (upstream_line("A, B", "200, 200", "0.1, 9e99", "0, 0", "0, 0"), "bad_upstream"),
    ],
)
def test_rejects(lines_of, text, reason):
    assert reason in REJECT_REASONS
    assert parse_one(lines_of, text).reason == reason


@pytest.mark.parametrize(
    "text",
    [
        line(status="0200"),
        line(status=" +200 "),
        line(gzip_ratio="1e-3"),
        line(gzip_ratio=" 2. "),
        line(request_time=".5"),
        line(request_time="9999999999999"),
        line(request_time="1e24", gzip_ratio="-1e15"),
        line(status="99999999999", bytes_sent="9" * 30, request_length="000" + "9" * 30),
        upstream_line("A, B", "1" * 60 + ", -5", "0.1, 9999999999999", "1e13, 0", "0, 0"),
        line() + "|one more|and more",
        line() + "\r",
        upstream_line("A, B", "200, 0200", "1e1, -", ", .5", "-, 12"),
    ],
)
def test_accepted_forms(lines_of, text):
    assert parse_one(lines_of, text).reason is None


def test_numbers_of_any_size(lines_of):
    from tallyweir import metric

    row = parse_one(lines_of, line(status=" +00099999999999 ", bytes_sent="-" + "9" * 30, request_time="123456789012345678"))
    assert (int(row.status), int(row.bytes_sent), row.request_time) == (99999999999, -int("9" * 30), 123456789012345678.0)
    text = upstream_line("A, A, B, C, D", f"{'7' * 25}, -00{'7' * 25}, +{'0' * 40}, -000, 00200", "1e13, 3e13, 1, 1, 1", "-, -, -, -, -", "-, -, -, -, -")
    found = {(r.upstream, r.status): r.value for r in metric(lines_of(text), "upstreams_status").collect()}
    assert found == {("A", "7" * 25): 2, ("A", "-" + "7" * 25): 2, ("B", "0"): 1, ("C", "0"): 1, ("D", "200"): 1}
    means = {r.upstream: r.value for r in metric(lines_of(text), "upstreams_response_time_mean").collect()}
    assert means == {"A": 2e13, "B": 1.0, "C": 1.0, "D": 1.0}


def test_late_bound_is_strict(lines_of):
    assert parse_one(lines_of, line(msec="1000"), late_before=1000.0).reason == "late"
    assert parse_one(lines_of, line(msec="1000.001"), late_before=1000.0).reason is None


def test_every_line_is_either_accepted_or_rejected(lines_of):
    lines = [line(), line(status="x"), "", line(msec="x"), upstream_line("-"), upstream_line("A", "")]
    parsed = parse_lines(lines_of(*lines))
    skipped = rejected(parsed).collect()
    assert accepted(parsed).count() + len(skipped) == len(lines)
    assert sorted(r.value for r in skipped) == sorted([lines[1], lines[2], lines[3], lines[5]])


def test_other_columns_pass_through(spark):
    frame = spark.createDataFrame([(7, line())], "id int, text string")
    row = parse_lines(frame, line="text").first()
    assert (row.id, row.text, row.reason) == (7, line(), None)


def test_same_results_without_ansi_mode(spark, lines_of):
    lines = [line(), line(status="x"), "1|5", upstream_line("-"), upstream_line("A, B", "200, 1", "1", "2", "3")]
    parsed = parse_lines(lines_of(*lines))
    want = sorted(map(str, parsed.collect()))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert sorted(map(str, parse_lines(lines_of(*lines)).collect())) == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_weights_of_repeated_servers_equal_the_definition(lines_of):
    import random
    from collections import Counter

    from tallyweir import metric

    rng = random.Random(8)
    lists = [[(rng.choice("ABCDE"), rng.choice(["200", "502", "-", "0200"])) for _ in range(n)] for n in (1, 2, 3, 7, 30, 200)]
    lines = lines_of(*[upstream_line(", ".join(s for s, _ in own), ", ".join(t for _, t in own), *[", ".join(["0.5"] * len(own))] * 3) for own in lists])
    hits, statuses = Counter(), Counter()
    for own in lists:
        met = Counter(s for s, _ in own)
        hits.update(met)
        for s, t in {(s, t.lstrip("0") or t) for s, t in own}:
            statuses[s, t] += met[s]
    assert {r.upstream: r.value for r in metric(lines, "upstreams_hits").collect()} == hits
    assert {(r.upstream, r.status): r.value for r in metric(lines, "upstreams_status").collect()} == statuses
    counted = {(r.at, s.status): s.n for r in request_summary(accepted(parse_lines(lines)).withColumn("at", F.col("upstreams_servers")), "at").collect() for s in r.statuses if r.at == 200 and r.server == "A"}
    assert counted == {(200, t): n for t, n in Counter(t.lstrip("0") or t for s, t in lists[-1] if s == "A").items()}


def test_time_of_long_lists_is_in_proportion(lines_of):
    import time

    from tallyweir import metric

    def seconds(n):
        servers = [f"10.0.{i % (n // 2) // 256}.{i % (n // 2) % 256}:80" for i in range(n)]
        text = upstream_line(*[", ".join(x) for x in (servers, ["200"] * n, ["0.1"] * n, ["-"] * n, ["0.3"] * n)])
        began = time.time()
        assert {r.value for r in metric(lines_of(text), "upstreams_status").collect()} == {2}
        return time.time() - began

    seconds(2000)
    assert seconds(32_000) < 12 * max(seconds(4000), 0.5)


def test_upstream_lists_of_any_length(spark, lines_of):
    from tallyweir import metric

    n = 10_000
    servers = [f"10.0.0.{i % 50}:80" for i in range(n)]
    long = upstream_line(*[", ".join(x) for x in (servers, ["200"] * n, ["0.1"] * n, ["-"] * n, ["0.3"] * n)])
    bad = upstream_line(", ".join(servers), ", ".join(["200"] * (n - 1) + ["x"]), *[", ".join(["0.1"] * n)] * 3)
    parsed = parse_lines(lines_of(long, bad)).collect()
    assert sorted((r.reason or "", r.upstreams_servers) for r in parsed) == [("", n), ("bad_upstream", n)]
    hits = {r.upstream: r.value for r in metric(lines_of(long, bad), "upstreams_hits").collect()}
    assert hits == {f"10.0.0.{i}:80": n // 50 for i in range(50)}
    statuses = {(r.upstream, r.status): r.value for r in metric(lines_of(long, bad), "upstreams_status").collect()}
    assert statuses == {(f"10.0.0.{i}:80", "200"): n // 50 for i in range(50)}
