"""Points: one row per metric, bucket and tag values, ready for a time-series store."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyweir.functions.buckets import bucket_time, check_duration
from tallyweir.functions.lineprotocol import (
    field_text,
    float_field,
    integer_field,
    known_tag_part,
    literal,
    render_line,
    tag_part,
    time_in_precision,
)
from tallyweir.operators.metrics import BASE_TAGS, METRICS, ZERO_IF_ANY, base_sums, rolled_up, sources_with

TAG_COLUMNS = (*BASE_TAGS, "upstream", "status")
POINT_COLUMNS = ("source", "measurement", "bucket", "epoch", "time", *TAG_COLUMNS, "value_i", "value_d")
POINT_SCHEMA = (
    "source string, bucket bigint, epoch bigint, time string, vhost string, protocol string, loctag string, "
    "upstream string, status string, value_i bigint, value_d double, measurement string"
)

# The value of a point as DOUBLE, whichever column holds it.
POINT_VALUE = "coalesce(double(value_i), value_d)"
NO_TAGS = "cast(map() AS MAP<STRING, STRING>)"


def points_from_partials(partials: DataFrame, bucket_duration: int = 60) -> DataFrame:
    """All metrics of the given (written) partials in long form, ``POINT_COLUMNS``.

    ``value_i`` holds whole-number values and ``value_d`` the others; ``epoch``
    and ``time`` are the right edge of the bucket.
    """
    check_duration(bucket_duration)
    candidates = ", ".join(_candidate(name) for name in METRICS)
    long = rolled_up(partials).selectExpr("source", "bucket", *TAG_COLUMNS, f"inline(array_compact(array({candidates})))")
    for name in ZERO_IF_ANY:
        long = long.unionByName(_zero_points(partials, name))
    return long.selectExpr(
        "source",
        "measurement",
        "bucket",
        f"bucket * {bucket_duration} AS epoch",
        f"{bucket_time('bucket', bucket_duration)} AS time",
        *TAG_COLUMNS,
        "value_i",
        "value_d",
    )


def _zero_points(partials: DataFrame, name: str) -> DataFrame:
    """Points of value 0 for sources that have others; no other point needs to know what else its source has."""
    sums = base_sums(partials, METRICS[name].needs)
    tags = [tag if tag in BASE_TAGS else f"string(NULL) AS {tag}" for tag in TAG_COLUMNS]
    zeros = sums.where(f"{METRICS[name].value} = 0").join(sources_with(sums, METRICS[name].needs[0]), "source", "left_semi")
    return zeros.selectExpr(
        "source", "bucket", *tags, f"'{name}' AS measurement", "0L AS value_i", "double(NULL) AS value_d"
    )


def _candidate(name: str) -> str:
    spec = METRICS[name]
    value = f"nullif({spec.value}, 0)" if spec.zero_if_any else spec.value
    # whole values beyond 64 bits are published as fractions
    whole, fraction = "bigint(NULL)", value
    if spec.whole:
        whole, fraction = f"try_cast({value} AS BIGINT)", f"CASE WHEN try_cast({value} AS BIGINT) IS NULL THEN double({value}) END"
    point = f"named_struct('measurement', '{name}', 'value_i', {whole}, 'value_d', {fraction})"
    return f"CASE WHEN grain = '{spec.grain}' AND ({value}) IS NOT NULL THEN {point} END"


def point_tags() -> str:
    """The point's own tags as a map; tags its grain lacks are left out."""
    pairs = ", ".join(f"'{name}', {name}" for name in TAG_COLUMNS)
    return f"map_filter(map({pairs}), (name, value) -> value IS NOT NULL)"


def static_tags(tags: Mapping[str, str | None] | None = None, *, name_from_source: bool = True) -> str:
    """Map of the tags shared by all points of a run, given as texts.

    ``name`` falls back to the source of the point.  Empty values are left out.
    """
    given = {name: literal(value) for name, value in (tags or {}).items() if name and value}
    if name_from_source:
        given.setdefault("name", "source")
    return tags_from(given)


def tags_from(columns: Mapping[str, str]) -> str:
    """Map of tags given as SQL expressions, for tags that depend on the source."""
    if not columns:
        return NO_TAGS
    pairs = ", ".join(f"{literal(name)}, string({value})" for name, value in columns.items())
    return f"map_filter(map({pairs}), (name, value) -> coalesce(value, '') <> '')"


def merge_tags(shared: str, own: str) -> str:
    """Both maps in one; where both have a name, ``own`` wins."""
    return f"map_concat(map_filter({shared}, (name, value) -> NOT map_contains_key({own}, name)), {own})"


def with_tags(points: DataFrame, shared: str = NO_TAGS) -> DataFrame:
    """Points with a ``tags`` map in place of the tag columns."""
    other = [c for c in points.columns if c not in TAG_COLUMNS]
    own = points.selectExpr(*other, f"{point_tags()} AS tags")
    return own if shared == NO_TAGS else own.selectExpr(*other, f"{merge_tags(shared, 'tags')} AS tags")


def check_precision(bucket_duration: int, precision: str) -> bool:
    """False, with a warning, when buckets of one tag set would share a rendered time."""
    step = {"m": 60, "h": 3600}.get(precision, 1)
    if bucket_duration % step:
        warnings.warn(
            f"buckets of {bucket_duration} s are no whole number of time units of {step} s: "
            "points of different buckets get the same time",
            stacklevel=2,
        )
        return False
    return True


def to_lines(
    points: DataFrame,
    shared: Mapping[str, str] | None = None,
    precision: str = "m",
    bucket_duration: int | None = None,
) -> DataFrame:
    """Render points; other columns stay, the text is in ``line``.

    ``shared`` holds more tags as SQL expressions; the point's own tags win over them.
    As all names are known, no map is built.
    """
    own = {**(shared or {}), **{name: name for name in TAG_COLUMNS}}
    return _rendered(points, known_tag_part(own), precision, bucket_duration)


def tagged_to_lines(tagged: DataFrame, precision: str = "m", bucket_duration: int | None = None) -> DataFrame:
    """Render points whose tags are in the map column ``tags``."""
    return _rendered(tagged, tag_part("tags"), precision, bucket_duration)


def _rendered(points: DataFrame, tags: str, precision: str, bucket_duration: int | None) -> DataFrame:
    if bucket_duration is not None:
        check_precision(bucket_duration, precision)
    value = f"coalesce({integer_field('value_i')}, {float_field('value_d')})"
    line = render_line("measurement", tags, {"value": value}, time_in_precision("epoch", precision))
    return points.selectExpr("*", f"{line} AS line")


def rows_to_lines(
    rows: DataFrame,
    measurement: str,
    fields: list[str],
    tags: str = NO_TAGS,
    epoch: str | None = None,
    precision: str | None = None,
) -> DataFrame:
    """Render any rows, several fields each; field texts follow the column types.

    ``measurement`` is a plain text, ``tags`` and ``epoch`` are SQL expressions.
    """
    texts = {name: field_text(f"`{name}`", rows.schema[name].dataType) for name in fields}
    time = None if epoch is None else time_in_precision(epoch, precision)
    return rows.selectExpr("*", f"{render_line(literal(measurement), tag_part(tags), texts, time)} AS line")
