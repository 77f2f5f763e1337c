from __future__ import annotations

import datetime as dt
import random

import compare
import pytest

from tallyweir.llm.queries import op3_url_filter, oracle_statements
from tallyweir.llm.urlfilter import intervals, judged

CHANGE = "list string, verdict string, kind string, pattern string, day date, listed boolean"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def brute_force(url, fetched, changes):
    """The deciding entry, by looking at the state of every entry on the day."""
    if url is None or fetched is None or "://" not in url:
        return ("none", None, None, None)
    rest = url.split("://", 1)[1]
    authority = rest.replace("?", "/").replace("#", "/").split("/")[0]
    host = authority.split("@")[-1].split(":")[0].lower().rstrip(".")
    path = rest[len(authority) :].split("?")[0].split("#")[0] or "/"
    best = None
    for entry in {c[:4] for c in changes if None not in c}:
        history = sorted((c[4], c[5]) for c in changes if c[:4] == entry and None not in c and c[4] <= fetched)
        if not history or not history[-1][1] or not host:
            continue
        name, verdict, kind, pattern = entry
        if kind == "host":
            hit = host == pattern
        elif kind == "domain":
            hit = host == pattern or host.endswith("." + pattern)
        else:
            hit = host + path == pattern or pattern.endswith("/") and (host + path).startswith(pattern)
        if hit:
            key = (verdict != "allow", {"host": 0, "path": 1, "domain": 2}[kind], -len(pattern), name, pattern)
            best = min(best or (key, entry), (key, entry))
    return (best[1][1], best[1][0], best[1][2], best[1][3]) if best else ("none", None, None, None)


def test_captures_equal_brute_force(spark):
    rng = random.Random(4)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "ba.com"]
    patterns = {"host": hosts, "domain": [*hosts, "com"], "path": [h + p for h in hosts for p in ("/", "/p/", "/p/q/", "/p/q", "/p")]}
    changes = []
    for _ in range(150):
        kind = rng.choice(list(patterns))
        changes.append((rng.choice("lmn"), rng.choice(["block", "block", "allow"]), kind, rng.choice(patterns[kind]), day(rng.randrange(40)), rng.random() < 0.6))
    changes += changes[:20] + [("l", "block", "host", "a.com", None, True), (None, "block", "host", "a.com", day(0), True), ("l", "block", "host", None, day(0), True)]
    urls = [f"http://{u}{h}{port}{p}" for u in ("", "me:pw@") for h in [*hosts, "A.COM.", "other.net"] for port in ("", ":80") for p in ("", "/", "/p", "/p/", "/p/q", "/p/q/r?x=/p/", "/pq#/p", "?p")]
    rows = [(i, u, day(rng.randrange(-2, 45)), "mine") for i, u in enumerate(urls)]
    rows += [(0, None, day(1), "n"), (1, "http://a.com/", None, "n"), (2, "no url", day(3), "n"), (3, "", day(3), "n"), (4, "http:///p", day(3), "n"), *rows[:3], (None, "http://a.com/" + "p/" * 500, day(20), "n")]
    captures = spark.createDataFrame(rows, "page_id bigint, url string, fetched date, pattern string")
    got = sorted(map(str, (tuple(r) for r in judged(captures, intervals(spark.createDataFrame(changes, CHANGE))).collect())))
    want = sorted(str((i, u, f, *brute_force(u, f, changes))) for i, u, f, _ in rows)
    assert got == want
    assert len({w.split(", ")[-4] for w in want}) == 3


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.com/", day(1))], "page_id bigint, url string, fetched date")
    none = intervals(spark.createDataFrame([], CHANGE))
    assert none.count() == 0
    assert [r.verdict for r in judged(captures, none).collect()] == ["none"]
    assert judged(captures.limit(0), none).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_query_equals_its_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    found = op3_url_filter(spark, sf_dir)
    assert compare.differences(found, compare.connect(sf_dir), oracle_statements()["op3_url_filter"]) is None
    verdicts = {r.verdict for r in found.select("verdict").distinct().collect()}
    assert verdicts == {"allow", "block", "none"}


def test_query_runs_no_python(spark):
    plan = op3_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_very_long_paths_cost_no_more(spark):
    import time

    changes = spark.createDataFrame([("l", "block", "path", "a.com/p/p/", day(0), True)], CHANGE)
    long = "http://a.com/" + "p/" * 100_000
    captures = spark.createDataFrame([(long, day(3)), ("http://a.com/q/" + "p/" * 100_000, day(3))], "url string, fetched date")
    began = time.time()
    assert {r.url[13]: r.verdict for r in judged(captures, intervals(changes)).collect()} == {"p": "block", "q": "none"}
    assert time.time() - began < 60
    none = intervals(changes.where("false"))
    assert {r.verdict for r in judged(captures, none).collect()} == {"none"} and judged(captures.where("false"), none).count() == 0
