from __future__ import annotations

import warnings

import pytest
from samples import bare_line, line, upstream_line

from tallyweir.functions.lineprotocol import (
    escape_name,
    escape_tag_value,
    field_text,
    float_field,
    known_tag_part,
    literal,
    render_line,
    tag_part,
    time_in_precision,
)
from tallyweir.operators.partials import partial_metrics
from tallyweir.operators.points import (
    check_precision,
    merge_tags,
    points_from_partials,
    rows_to_lines,
    static_tags,
    tagged_to_lines,
    to_lines,
    with_tags,
)
from tallyweir.operators.runstats import RunStats, stats_frame, stats_lines
from tallyweir.sources.scratch import written


def value(spark, sql):
    return spark.sql(f"SELECT {sql} AS v").first().v


@pytest.mark.parametrize(
    ("text", "escaped"),
    [
        ("plain", "plain"),
        ("a b", "a\\ b"),
        ("a,b=c", "a\\,b\\=c"),
        ("back\\slash", "back\\\\slash"),
        ("two\nlines", "two\\nlines"),
        ("\\ ,=\n'", "\\\\\\ \\,\\=\\n'"),
        ("$1", "$1"),
    ],
)
def test_names_are_escaped(spark, text, escaped):
    assert value(spark, literal(text)) == text
    assert value(spark, escape_name(literal(text))) == escaped
    assert value(spark, escape_tag_value(literal(text))) == escaped


def test_a_blank_follows_a_final_backslash(spark):
    assert value(spark, escape_tag_value(literal("ends\\"))) == "ends\\\\ "
    assert value(spark, escape_name(literal("ends\\"))) == "ends\\\\"


@pytest.mark.parametrize(
    ("number", "text"),
    [
        ("0.026D", "0.026"),
        ("1e-5D", "1e-05"),
        ("12345678.9D", "12345678.9"),
        ("2D", "2.0"),
        ("100D", "100.0"),
        ("0D", "0.0"),
        ("1e-9D", "1e-09"),
        ("-1.50D", "-1.5"),
        ("1e12D", "1000000000000.0"),
        ("1e15D", "1000000000000000.0"),
        ("1e16D", "1e+16"),
        ("-1e300D", "-1e+300"),
        ("1.5e-300D", "1.5e-300"),
        ("4.9E-324D", "5e-324"),
        ("0.0001D", "0.0001"),
        ("double('NaN')", None),
        ("double('-Infinity')", None),
        ("CAST(NULL AS DOUBLE)", None),
    ],
)
def test_floats_are_plain_text(spark, number, text):
    assert value(spark, float_field(number)) == text


def test_floats_are_the_shortest_that_read_back(spark):
    import random

    rng = random.Random(4)
    numbers = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)] + [2.0**k for k in range(-1070, 1020, 7)]
    numbers += [rng.randrange(10**16) / 10.0 ** rng.randrange(18) for _ in range(2000)]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").selectExpr("x", f"{float_field('x')} AS text").collect()
    assert all(float(r.text) == r.x and len(r.text) == len(repr(r.x)) for r in rows)
    # where the last of 17 digits may be one of two, both read back
    assert sum(r.text != repr(r.x) for r in rows) <= 4


def test_fields_follow_their_types(spark):
    row = spark.sql("SELECT 5 AS i, 7L AS l, 2.5D AS d, true AS yes, false AS no, 'say \"a\\\\b\"\n' AS s, "
                    "CAST(NULL AS INT) AS n")
    texts = row.selectExpr(*[f"{field_text(f.name, f.dataType)} AS {f.name}" for f in row.schema]).first()
    assert tuple(texts) == ("5i", "7i", "2.5", "True", "False", '"say \\"a\\\\b\\"\\n"', None)


def test_lines_sort_tags_and_fields_and_leave_out_empty_ones(spark):
    tags = "map('b', 'x y', 'a', '1', 'empty', '', 'none', NULL, '', 'no name')"
    fields = {"z": "'1i'", "f": "'2.5'", "absent": "CAST(NULL AS STRING)"}
    assert value(spark, render_line("'m 1'", tag_part(tags), fields, "60L")) == "m\\ 1,a=1,b=x\\ y f=2.5,z=1i 60"
    assert value(spark, render_line("'m'", tag_part("map()"), {"z": "'1i'"})) == "m z=1i"
    assert value(spark, render_line("'m'", "''", {"z": "CAST(NULL AS STRING)"}, "1L")) == "m 1"
    known = {"b": "'x y'", "a": "'1'", "empty": "''", "none": "CAST(NULL AS STRING)"}
    assert value(spark, known_tag_part(known)) == ",a=1,b=x\\ y"
    assert value(spark, known_tag_part({})) == ""


@pytest.mark.parametrize(
    ("precision", "want"),
    [(None, 119_500_000_000), ("n", 119_500_000_000), ("u", 119_500_000), ("ms", 119_500), ("s", 119), ("m", 1), ("h", 0)],
)
def test_time_precisions_floor(spark, precision, want):
    assert value(spark, time_in_precision("119.5D", precision)) == want
    assert value(spark, time_in_precision("-1L", "m")) == -1


def test_unknown_precision():
    with pytest.raises(ValueError):
        time_in_precision("1", "x")


def test_buckets_that_share_a_minute_warn():
    with pytest.warns(UserWarning, match="same time"):
        assert not check_precision(30, "m")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert check_precision(60, "m") and check_precision(30, "s")


def test_point_tags_win_over_shared_ones(spark):
    merged = value(spark, merge_tags("map('host', 'h', 'vhost', 'shared')", "map('vhost', 'own')"))
    assert merged == {"host": "h", "vhost": "own"}


def points_of(lines):
    return points_from_partials(written(partial_metrics(lines), "test-points"))


def test_points_as_lines(lines_of):
    text = upstream_line("A, A", "502, 200", "1.0, 2.0", "0.5, -", "-, -", msec="120", vhost="a b", protocol="-")
    points = points_of(lines_of(text))
    plain = "loctag=ws,protocol=http"
    want = {
        f"hits,{plain},vhost=a\\ b value=1i 2",
        f"bytes_sent,{plain},vhost=a\\ b value=2799i 2",
        f"gzip_count,{plain},vhost=a\\ b value=1i 2",
        f"gzip_count_percent,{plain},vhost=a\\ b value=1.0 2",
        f"gzip_ratio_mean,{plain},vhost=a\\ b value=2.5 2",
        f"request_length_mean,{plain},vhost=a\\ b value=289i 2",
        f"request_time_mean,{plain},vhost=a\\ b value=0.026 2",
        f"status,{plain},status=200,vhost=a\\ b value=1i 2",
        f"hits_with_upstream,{plain},vhost=a\\ b value=1i 2",
        f"upstreams_servers,{plain},vhost=a\\ b value=2i 2",
        f"upstreams_servers_contacted_per_hit,{plain},vhost=a\\ b value=2.0 2",
        f"upstreams_internal_redirects_per_hit,{plain},vhost=a\\ b value=0.0 2",
        f"upstreams_hits,{plain},upstream=A,vhost=a\\ b value=2i 2",
        f"upstreams_response_time_mean,{plain},upstream=A,vhost=a\\ b value=1.5 2",
        f"upstreams_connect_time_mean,{plain},upstream=A,vhost=a\\ b value=0.5 2",
        f"upstreams_status,{plain},status=200,upstream=A,vhost=a\\ b value=2i 2",
        f"upstreams_status,{plain},status=502,upstream=A,vhost=a\\ b value=2i 2",
    }
    assert {r.line for r in to_lines(points).collect()} == want
    assert {r.line for r in tagged_to_lines(with_tags(points)).collect()} == want
    assert {r.time for r in points.collect()} == {"1970-01-01T00:02:00+00:00"}


def test_static_tags_fall_back_to_the_source(lines_of):
    points = points_of(lines_of(("web1/site.log", bare_line("120"))))
    tags = with_tags(points, static_tags({"host": "h1", "dc": "", "name": None})).first().tags
    assert (tags["host"], tags["name"], "dc" in tags) == ("h1", "web1/site.log", False)
    named = with_tags(points, static_tags({"name": "n1", "dc": "x"})).first().tags
    assert (named["name"], named["dc"]) == ("n1", "x")
    shared = {"host": "'h1'", "vhost": "'other'"}
    assert all(",host=h1," in r.line and "vhost=www.example.org" in r.line for r in to_lines(points, shared).collect())


def test_run_stats_line(spark):
    stats = RunStats.measured(3, 1200.0, 12.34, 4.56, 1000, 10, 68, 5)
    assert (stats.duration_seconds, stats.parse_duration_seconds) == (12.3, 4.6)
    text = stats_lines(stats_frame(spark, stats), "map('host', 'h 1')").first().line
    assert text == (
        "run_stats,host=h\\ 1 duration_seconds=12.3,mean_time_per_line_seconds=0.0046,parse_duration_seconds=4.6,"
        "parsed_lines=1000i,resent_points=5i,sent_points=68i,skipped_lines=10i 20"
    )
    idle = RunStats.measured(4, 0.0, 1.0, 2.0, 0, 0, 0, 0)
    assert (idle.parse_duration_seconds, idle.mean_time_per_line_seconds) == (0.0, 0.0)


def test_rows_with_several_fields(spark):
    rows = spark.sql("SELECT 1 AS a, 'x' AS b, 0.5D AS c")
    assert rows_to_lines(rows, "my own", ["a", "b", "c"]).first().line == 'my\\ own a=1i,b="x",c=0.5'
    assert line().count("|") == 14
