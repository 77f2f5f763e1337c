"""The seventeen published metrics, singly or all at once.

``metric`` answers one metric with one aggregate at its own grain, so column
pruning drops the work of the others.  ``metrics_wide`` and the points (see
``points``) read all metrics from the partials of a single pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyweir.functions.numbers import mean_from_micros
from tallyweir.operators.contacts import explode_contacts
from tallyweir.operators.partials import (
    CONTACT,
    CONTACT_MEASURES,
    REQUEST,
    REQUEST_MEASURES,
    REQUEST_SUMS,
    SUMS,
    protocol_label,
    sums_of,
    with_source,
)
from tallyweir.operators.requests import accepted, parse_lines

BASE_TAGS = ("vhost", "protocol", "loctag")
# The tags of each grain beyond the bucket.
GRAIN_TAGS = {
    "base": BASE_TAGS,
    "status": (*BASE_TAGS, "status"),
    "upstream": (*BASE_TAGS, "upstream"),
    "upstream_status": (*BASE_TAGS, "upstream", "status"),
}


@dataclass(frozen=True)
class Metric:
    """A published metric: its grain, the sums it needs, and its value from them (NULL: no row)."""

    grain: str
    needs: tuple[str, ...]
    value: str
    whole: bool = True
    # zero rows are published only if the run has some other value for the source
    zero_if_any: bool = False


def _sum(name: str, grain: str = "base") -> Metric:
    return Metric(grain, (name,), name)


def _mean(total: str, count: str, grain: str = "base") -> Metric:
    return Metric(grain, (total, count), mean_from_micros(total, count), whole=False)


def _ratio(top: str, bottom: str) -> Metric:
    return Metric("base", (top, bottom), f"CASE WHEN {bottom} > 0 THEN {top} / {bottom} END", whole=False)


# The published names, in their order.
METRICS: dict[str, Metric] = {
    "hits": _sum("hits"),
    "hits_with_upstream": Metric("base", ("hits_with_upstream",), "nullif(hits_with_upstream, 0)"),
    "status": _sum("hits", "status"),
    "bytes_sent": _sum("bytes_sent"),
    "gzip_count": Metric("base", ("gzip_n",), "gzip_n", zero_if_any=True),
    "gzip_count_percent": _ratio("gzip_n", "hits"),
    "gzip_ratio_mean": _mean("gzip_us", "gzip_n"),
    # published as a whole number, cut and not rounded
    "request_length_mean": Metric("base", ("request_length", "hits"), "CAST(double(request_length) / hits - double(request_length) / hits % 1 AS DECIMAL(38, 0))"),
    # a request without a time counts in no mean
    "request_time_mean": _mean("time_us", "time_n"),
    "upstreams_hits": _sum("contact_hits", "upstream"),
    "upstreams_status": _sum("status_hits", "upstream_status"),
    "upstreams_servers_contacted_per_hit": _ratio("servers_contacted", "hits_with_upstream"),
    "upstreams_internal_redirects_per_hit": _ratio("internal_redirects", "hits_with_upstream"),
    "upstreams_servers": Metric(
        "base", ("upstreams_servers", "hits_with_upstream"), "CASE WHEN hits_with_upstream > 0 THEN upstreams_servers END"
    ),
    "upstreams_response_time_mean": _mean("response_us", "response_n", "upstream"),
    "upstreams_connect_time_mean": _mean("connect_us", "connect_n", "upstream"),
    "upstreams_header_time_mean": _mean("header_us", "header_n", "upstream"),
}

ZERO_IF_ANY = tuple(name for name, m in METRICS.items() if m.zero_if_any)
BASE_METRICS = tuple(name for name, m in METRICS.items() if m.grain == "base")


def metric(
    lines: DataFrame, name: str, bucket_duration: int = 60, weighting: str = "per_request", line: str = "value"
) -> DataFrame:
    """One metric straight from lines: source, bucket, its tags and ``value``."""
    return metric_of_parsed(parse_lines(with_source(lines), bucket_duration, line=line), name, weighting)


def metric_of_parsed(parsed: DataFrame, name: str, weighting: str = "per_request") -> DataFrame:
    spec = METRICS[name]
    tags = GRAIN_TAGS[spec.grain]
    keys = ["source", "bucket", *BASE_TAGS]
    if "upstream" in tags:
        rows = explode_contacts(parsed, keys, weighting).withColumnRenamed("upstream_status", "status")
        own = {"upstream": "upstream", "status": "status"}
        measures = CONTACT_MEASURES
    else:
        rows, own, measures = accepted(parsed), {"status": "string(status)"}, REQUEST_MEASURES
    own["protocol"] = protocol_label("protocol")
    rows = rows.selectExpr(
        "source",
        "bucket",
        *[f"{own.get(tag, tag)} AS {tag}" for tag in tags],
        *[f"{measures[n]} AS {n}" for n in spec.needs],
    )
    sums = rows.groupBy("source", "bucket", *tags).agg(*sums_of(*spec.needs))
    if spec.zero_if_any:
        sums = sums.join(sources_with(sums, spec.needs[0]), "source", "left_semi")
    return sums.selectExpr("source", "bucket", *tags, f"{spec.value} AS value").where("value IS NOT NULL")


def sources_with(sums: DataFrame, name: str) -> DataFrame:
    # The same aggregate as the other side of the join, so its exchange is reused.
    return sums.groupBy("source").agg(F.expr(f"max({name}) AS most")).where("most > 0").select("source")


def metrics_wide(partials: DataFrame) -> DataFrame:
    """All base-grain metrics as columns, one row per source, bucket and base tags.

    Expects written partials (see ``tallyweir.sources.scratch``): they are read twice, once
    for the run-wide presence of compression.
    """
    return with_gzip_presence(base_sums(partials, REQUEST_SUMS), partials).selectExpr(
        "source", "bucket", *BASE_TAGS, *[f"{published_value(name)} AS {name}" for name in BASE_METRICS]
    )


def base_sums(partials: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Sums of the requests at the base grain."""
    return partials.where(F.col("kind") == REQUEST).groupBy("source", "bucket", *BASE_TAGS).agg(*sums_of(*names))


def published_value(name: str) -> str:
    """Value of a metric over sums joined with ``any_gzip``."""
    spec = METRICS[name]
    return f"CASE WHEN any_gzip THEN {spec.value} END" if spec.zero_if_any else spec.value


def with_gzip_presence(sums: DataFrame, partials: DataFrame) -> DataFrame:
    """Add ``any_gzip``: does the run have a compressed response for this source?"""
    requests = partials.where(F.col("kind") == REQUEST)
    return sums.join(requests.groupBy("source").agg(F.expr("max(gzip_n) > 0 AS any_gzip")), "source")


def rolled_up(partials: DataFrame) -> DataFrame:
    """Partials summed to all four grains; the column ``grain`` tells which.

    A request row feeds the grains base and status, a contact row the grains
    upstream and upstream_status.  Partials are small next to the lines, so
    doubling and shuffling them once more costs little.
    """
    doubled = partials.where(F.col("kind").isin(REQUEST, CONTACT)).selectExpr(
        "*", "explode(array(false, true)) AS _fine"
    )
    grain = (
        f"CASE WHEN kind = '{CONTACT}' THEN if(_fine, 'upstream_status', 'upstream') "
        "ELSE if(_fine, 'status', 'base') END AS grain"
    )
    return (
        doubled.selectExpr(
            "source", grain, "bucket", *BASE_TAGS, "upstream", "CASE WHEN _fine THEN status END AS status", *SUMS
        )
        .groupBy("source", "grain", "bucket", *BASE_TAGS, "upstream", "status")
        .agg(*sums_of(*SUMS))
    )
