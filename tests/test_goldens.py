"""Totals over the derived access log of 10,000 lines, worked out beforehand without Spark."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyweir.operators.increment import advance_marks, open_partials
from tallyweir.operators.metrics import rolled_up
from tallyweir.operators.partials import line_counts, partial_metrics, skip_counts
from tallyweir.plans.inputs import access_log
from tallyweir.sources.scratch import written


@pytest.fixture(scope="module")
def partials(spark):
    return written(partial_metrics(access_log(spark, "/root/testdata/sf0.01"), 3600), "goldens")


def test_lines(partials):
    assert line_counts(partials).first()[1:] == (10_000, 593)
    assert {r.reason: r.lines for r in skip_counts(partials).collect()} == {
        "bad_version": 103,
        "bad_msec": 98,
        "short_line": 89,
        "bad_status": 78,
        "bad_upstream": 77,
        "bad_bytes_sent": 76,
        "bad_gzip_ratio": 72,
    }


def test_grains(partials):
    sums = rolled_up(partials)
    totals = {
        r.grain: r
        for r in sums.groupBy("grain")
        .agg(
            F.count("*").alias("groups"),
            *[F.sum(c).alias(c) for c in sums.columns if sums.schema[c].dataType.typeName() in ("long", "decimal")],
            F.expr("count_if(gzip_n > 0)").alias("with_gzip"),
            F.expr("count_if(hits_with_upstream > 0)").alias("with_upstream"),
            F.expr("count_if(connect_n > 0)").alias("with_connect"),
            F.expr("count_if(header_n > 0)").alias("with_header"),
            F.countDistinct("bucket").alias("buckets"),
            F.min("bucket").alias("first"),
            F.max("bucket").alias("last"),
        )
        .collect()
    }
    base, upstream = totals["base"], totals["upstream"]
    assert (base.buckets, base.first, base.last) == (720, 473353, 474072)
    assert (base.groups, base.hits, base.bytes_sent) == (7_764, 9_407, 46_817_525)
    assert (base.with_gzip, base.gzip_n) == (2_939, 3_136)
    assert base.hits - base.time_n == 91
    assert (base.with_upstream, base.hits_with_upstream) == (6_432, 7_508)
    assert (base.servers_contacted, base.internal_redirects, base.upstreams_servers) == (11_262, 1_878, 11_734)
    assert totals["status"].groups == 8_582
    assert (upstream.groups, upstream.contact_hits) == (9_685, 11_734)
    assert (upstream.response_us, upstream.response_n) == (4_541_091_000, 14_550)
    assert (upstream.with_connect, upstream.connect_us, upstream.connect_n) == (8_317, 11_734_000, 10_325)
    assert (upstream.with_header, upstream.header_us, upstream.header_n) == (6_809, 1_460_868_000, 8_450)
    assert (totals["upstream_status"].groups, totals["upstream_status"].status_hits) == (11_272, 14_550)


def test_leftover(partials):
    marks = advance_marks(partials.limit(0), partials, 3600, 2)
    assert open_partials(partials, marks).agg(F.sum("hits")).first()[0] == 27
