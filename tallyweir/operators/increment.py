"""Runs over a growing log: what is late, what is closed, what stays open.

Everything here works on partials (see ``partials``), which are small, and on
marks, one row per source.  Lines themselves are never joined with state.

A bucket is closed once the source has reached ``lookback_factor`` buckets
beyond it.  All open buckets up to that point close together, so none is lost
after a gap in traffic, and each bucket is published once: lines that arrive
for a closed bucket are late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyweir.functions.buckets import bucket_of
from tallyweir.functions.numbers import decimal_number
from tallyweir.operators.partials import CONTACT, PARTIAL_COLUMNS, REQUEST, SKIP, with_source
from tallyweir.operators.requests import FIELD_SEPARATOR, LAST_SECOND, REASONS_BEFORE_LATE

# Reason of the lines of a source that the first run has only noted.
BASELINE = "baseline"
MARKS_SCHEMA = "source string, last_msec double, closed_through bigint"


def marks_from_times(times: DataFrame, bucket_duration: int, lookback_factor: int) -> DataFrame:
    """Marks from rows of ``source`` and ``last_msec``; the highest time of a source wins."""
    highest = times.groupBy("source").agg(F.max("last_msec").alias("last_msec")).where("last_msec IS NOT NULL")
    return highest.selectExpr(
        "source", "last_msec", f"{bucket_of('last_msec', bucket_duration)} - {lookback_factor} AS closed_through"
    )


def advance_marks(
    previous: DataFrame, partials: DataFrame, bucket_duration: int, lookback_factor: int
) -> DataFrame:
    """Marks after a run; they never move back."""
    seen = partials.where(F.col("kind") == REQUEST).select("source", "last_msec")
    times = previous.select("source", "last_msec").unionByName(seen)
    return marks_from_times(times, bucket_duration, lookback_factor)


def baseline(lines: DataFrame, bucket_duration: int, lookback_factor: int, line: str = "value") -> DataFrame:
    """First run: per source the line count, the last bucket and the mark; nothing else is checked.

    The mark is set so that the next run starts with the bucket after the last one seen.
    """
    msec = decimal_number(f"get(split(`{line}`, r'{FIELD_SEPARATOR}', 3), 1)")
    ends = (
        with_source(lines)
        .selectExpr("source", f"{msec} AS msec")
        .groupBy("source")
        .agg(F.expr("count(*) AS lines"), F.expr(f"max(msec) FILTER (WHERE msec <= {LAST_SECOND!r}D) AS msec"))
    )
    return ends.selectExpr(
        "source", "lines", f"coalesce({bucket_of('msec', bucket_duration)}, 0) AS bucket"
    ).selectExpr(
        "source",
        "lines",
        "bucket",
        f"double((bucket + {lookback_factor}) * {bucket_duration}) AS last_msec",
        "bucket AS closed_through",
    )


def label_skips(
    partials: DataFrame, marks: DataFrame, last_bucket: int | None = None, skip_new_sources: bool = False
) -> DataFrame:
    """Turn rows into skips: ``late`` ones of closed buckets, ``future`` ones beyond ``last_bucket``, and with
    ``skip_new_sources`` all others of sources without a mark, as ``baseline``.

    All this is a property of source and bucket, so it is decided on the added-up rows.
    """
    # a row per source goes to the others, of which one source may have nearly all
    joined = partials.join(F.broadcast(marks.selectExpr("source", "closed_through", "true AS _known")), "source", "left")
    checked_first = ", ".join(f"'{reason}'" for reason in REASONS_BEFORE_LATE)
    unreadable = f"kind = '{SKIP}' AND status IN ({checked_first})"
    reason = (
        f"CASE WHEN {unreadable} AND (_known OR {not skip_new_sources}) THEN NULL "
        f"WHEN bucket > {last_bucket if last_bucket is not None else 'NULL'} THEN 'future' "
        f"WHEN _known IS NULL AND {skip_new_sources} THEN '{BASELINE}' "
        "WHEN bucket <= closed_through THEN 'late' END"
    )
    changed = {
        "source": "source",
        "bucket": "bucket",
        "lines": "lines",
        "kind": f"if(_reason IS NOT NULL, '{SKIP}', kind)",
        "status": "coalesce(_reason, status)",
    }
    more = [c for c in partials.columns if c not in PARTIAL_COLUMNS]
    return (
        joined.selectExpr(*PARTIAL_COLUMNS, *more, f"{reason} AS _reason")
        .where(f"NOT (_reason IS NOT NULL AND kind = '{CONTACT}')")
        .selectExpr(*[f"{changed.get(c, f'if(_reason IS NOT NULL, NULL, {c})')} AS {c}" for c in PARTIAL_COLUMNS], *more)
    )


def baseline_marks(partials: DataFrame, bucket_duration: int, lookback_factor: int) -> DataFrame:
    """Marks of the sources that a run has only noted: the next run starts with the bucket after the last one seen."""
    ends = partials.where(f"kind = '{SKIP}' AND status = '{BASELINE}'").groupBy("source").agg(F.max("bucket").alias("bucket"))
    return ends.selectExpr("source", "coalesce(bucket, 0) AS bucket").selectExpr(
        "source",
        f"double((bucket + {lookback_factor}) * {bucket_duration}) AS last_msec",
        "bucket AS closed_through",
    )


def _measured(partials: DataFrame, marks: DataFrame) -> DataFrame:
    return partials.where(F.col("kind").isin(REQUEST, CONTACT)).join(
        marks.select("source", "closed_through"), "source"
    )


def closed_partials(partials: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of the buckets that the marks close."""
    return _measured(partials, marks).where("bucket <= closed_through").select(*PARTIAL_COLUMNS)


def open_partials(partials: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of the buckets still open, ready to be added to the next run."""
    rows = _measured(partials, marks).where("bucket > closed_through")
    return rows.withColumn("lines", F.lit(0).cast("bigint")).select(*PARTIAL_COLUMNS)
