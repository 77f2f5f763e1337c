"""One pass from lines to additive partial metrics.

Each line becomes one row (a request or a skip) plus one row per contact, all
grouped by a single aggregate whose map side collapses them before the
shuffle.  Every metric is a sum or a quotient of sums, so partials of two runs,
two files or two halves of a bucket merge by adding.  The coarser grains are
rolled up from these rows, never from the lines again.

Skips are counted in the same pass, per reason, because counters kept outside
the data (accumulators) count a map task twice when its executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyweir.functions.numbers import micros
from tallyweir.operators.contacts import explode_contacts
from tallyweir.operators.requests import REQUEST_COLUMNS, parse_lines

REQUEST, CONTACT, SKIP = "request", "contact", "skip"

# status: of the request, of the contact, or the reason of the skip
PARTIAL_KEYS = ("source", "kind", "bucket", "vhost", "protocol", "loctag", "upstream", "status")

# Counts fit 64 bits; sums of what lines say need not.
WIDE = "DECIMAL(38, 0)"


def wide(number: str) -> str:
    return f"CAST({number} AS {WIDE})"


def weighted(number: str) -> str:
    return wide(f"CAST({number} AS DECIMAL(31, 0)) * CAST(weight AS DECIMAL(8, 0))")


def protocol_label(protocol: str) -> str:
    return f"CASE WHEN {protocol} = 's' THEN 'https' ELSE 'http' END"


# These are wide from the first addition.
WIDE_SUMS = ("bytes_sent", "gzip_us", "request_length", "time_us", "response_us", "connect_us", "header_us")

# Summable measures of one accepted request.
REQUEST_MEASURES = {
    "hits": "1L",
    "bytes_sent": wide("bytes_sent"),
    "gzip_n": "bigint(gzip_ratio IS NOT NULL)",
    "gzip_us": wide(micros("gzip_ratio")),
    "request_length": wide("request_length"),
    "time_n": "bigint(request_time IS NOT NULL)",
    "time_us": wide(micros("request_time")),
    "hits_with_upstream": "bigint(servers_contacted IS NOT NULL)",
    "servers_contacted": "bigint(servers_contacted)",
    "internal_redirects": "bigint(internal_redirects)",
    "upstreams_servers": "bigint(upstreams_servers)",
}
# Summable measures of one exploded contact.
CONTACT_MEASURES = {
    "contact_hits": "1L",
    "response_us": weighted("response_us"),
    "response_n": "CASE WHEN response_us IS NOT NULL THEN weight END",
    "connect_us": weighted("connect_us"),
    "connect_n": "CASE WHEN connect_us IS NOT NULL THEN weight END",
    "header_us": weighted("header_us"),
    "header_n": "CASE WHEN header_us IS NOT NULL THEN weight END",
    "status_hits": "status_hits",
}
REQUEST_SUMS = tuple(REQUEST_MEASURES)
CONTACT_SUMS = tuple(CONTACT_MEASURES)
SUMS = REQUEST_SUMS + CONTACT_SUMS
# lines: how many lines this run read for the row; rows carried over from an earlier run hold 0
PARTIAL_COLUMNS = (*PARTIAL_KEYS, "lines", *SUMS, "last_msec")


def with_source(lines: DataFrame) -> DataFrame:
    """Every line belongs to a source; lines without that column, or with a null in it, share the empty one."""
    named = F.coalesce("source", F.lit("")) if "source" in lines.columns else F.lit("")
    return lines.withColumn("source", named)


def contributions(
    lines: DataFrame, bucket_duration: int = 60, weighting: str = "per_request", line: str = "value"
) -> DataFrame:
    """The rows to add up: ``PARTIAL_COLUMNS`` at one row per line and per contact."""
    return contributions_of(parse_lines(with_source(lines), bucket_duration, line=line), weighting)


def contributions_of(parsed: DataFrame, weighting: str = "per_request", skips: bool = True, line: str | None = None) -> DataFrame:
    """The same from parsed lines; without ``skips`` a rejected line gives no row.

    ``line`` is a column with the text that a rejected line takes along as ``line``.
    """
    line_and_contacts = "CASE WHEN contacts IS NULL THEN array(NULL) ELSE array_prepend(contacts, NULL) END"
    otherwise = "array(NULL)" if skips else "NULL"
    rows = f"CASE WHEN reason IS NULL THEN {line_and_contacts} ELSE {otherwise} END"
    passed = [*REQUEST_COLUMNS[:-1], "source", "reason", *([line] if line else [])]
    exploded = explode_contacts(parsed, passed, weighting, rows, first=0)
    return exploded.selectExpr(
        "source",
        f"CASE WHEN reason IS NOT NULL THEN '{SKIP}' WHEN at > 0 THEN '{CONTACT}' ELSE '{REQUEST}' END AS kind",
        "bucket",
        *[f"CASE WHEN reason IS NULL THEN {tag} END AS {tag}" for tag in ("vhost", "loctag")],
        f"CASE WHEN reason IS NULL THEN {protocol_label('protocol')} END AS protocol",
        "upstream",
        "CASE WHEN reason IS NOT NULL THEN reason WHEN at > 0 THEN upstream_status ELSE string(status) END AS status",
        "CASE WHEN at = 0 THEN 1L ELSE 0L END AS lines",
        *[f"CASE WHEN at = 0 AND reason IS NULL THEN {m} END AS {name}" for name, m in REQUEST_MEASURES.items()],
        *[f"CASE WHEN at > 0 THEN {m} END AS {name}" for name, m in CONTACT_MEASURES.items()],
        "CASE WHEN at = 0 AND reason IS NULL THEN msec END AS last_msec",
        *([f"CASE WHEN reason IS NOT NULL THEN {line} END AS line"] if line else []),
    ).select(*PARTIAL_COLUMNS, *(["line"] if line else []))


def add_up(rows: DataFrame, *more_keys: str) -> DataFrame:
    """Merge partial rows of equal keys; the only shuffle between lines and partials."""
    sums = sums_of("lines", *SUMS)
    return rows.groupBy(*PARTIAL_KEYS, *more_keys).agg(*sums, F.max("last_msec").alias("last_msec"))


def sums_of(*names: str) -> list[Column]:
    return [F.expr(f"sum({name}) AS {name}") for name in names]


def partial_metrics(
    lines: DataFrame, bucket_duration: int = 60, weighting: str = "per_request", line: str = "value"
) -> DataFrame:
    """Additive partials of all lines, accepted and skipped."""
    return add_up(contributions(lines, bucket_duration, weighting, line))


def skip_counts(partials: DataFrame) -> DataFrame:
    """Skipped lines per source and reason."""
    return (
        partials.where(F.col("kind") == SKIP)
        .groupBy("source", F.col("status").alias("reason"))
        .agg(F.sum("lines").alias("lines"))
    )


def line_counts(partials: DataFrame) -> DataFrame:
    """Parsed and skipped lines per source."""
    skipped = F.sum(F.when(F.col("kind") == SKIP, F.col("lines")).otherwise(0))
    return partials.groupBy("source").agg(
        F.sum("lines").alias("parsed_lines"), skipped.alias("skipped_lines")
    )
