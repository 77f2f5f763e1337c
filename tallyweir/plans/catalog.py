"""The registered queries: each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyweir.functions.buckets import bucket_time
from tallyweir.functions.lineprotocol import float_field
from tallyweir.operators.contacts import TIMES, contact_rows, request_summary
from tallyweir.operators.flat_contacts import flat_contact_means, flat_contact_statuses
from tallyweir.operators.increment import advance_marks, baseline, closed_partials, open_partials
from tallyweir.operators.metrics import GRAIN_TAGS, METRICS, metric, metrics_wide
from tallyweir.operators.outbox import replayed, retained
from tallyweir.operators.partials import CONTACT_SUMS, REQUEST, partial_metrics, skip_counts, sums_of
from tallyweir.operators.points import POINT_VALUE, points_from_partials, static_tags, tags_from, to_lines, with_tags
from tallyweir.operators.requests import accepted, parse_lines, rejected
from tallyweir.operators.runstats import STATS_SCHEMA, stats_frame, stats_lines
from tallyweir.options import RunOptions
from tallyweir.plans.inputs import (
    BUCKET_DURATION,
    EVENT_COLUMNS,
    ORDER_BUCKET_DURATION,
    access_log,
    access_log_by_host,
    access_log_of,
    by_host,
    host_events,
    log_line,
    order_contacts,
    rename_logs,
    spread,
    supplier_log,
    table,
    wide_log,
    write_logs,
)
from tallyweir.sources.follow import LogFiles
from tallyweir.sources.ledger import SendOnce
from tallyweir.sources.logs import cap_lines, read_log
from tallyweir.sources.scratch import shared_folder, written
from tallyweir.sources.sinks import batch_bodies, register_measurements, write_points
from tallyweir.streaming.per_source import skipped_by_source, start_by_source
from tallyweir.streaming.runs import MetricsRuns, stream_runs
from tallyweir.streaming.watermarked import closed_bucket_points, start_closed_buckets

Query = Callable[[SparkSession, str], DataFrame]

LOOKBACK = 2
BASE_KEYS = ("vhost", "protocol", "loctag")
POINT_KEYS = ("vhost", "protocol", "loctag", "upstream", "status", "value_i", "value_d")
RUN_OPTIONS = RunOptions(bucket_duration=BUCKET_DURATION, lookback_factor=LOOKBACK, skip_to_end=False)


def _time() -> Column:
    return F.expr(f"{bucket_time('bucket', BUCKET_DURATION)} AS time")


def _day() -> Column:
    return F.expr(bucket_time("bucket", ORDER_BUCKET_DURATION))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(parse_lines(access_log(spark, sf_dir), BUCKET_DURATION))


def _partials(lines: DataFrame) -> DataFrame:
    return written(partial_metrics(lines, BUCKET_DURATION), "partials")


def _points(lines: DataFrame) -> DataFrame:
    return points_from_partials(_partials(lines), BUCKET_DURATION)


def _marks(partials: DataFrame) -> DataFrame:
    none_yet = partials.select("source", "last_msec").limit(0)
    return advance_marks(none_yet, partials, BUCKET_DURATION, LOOKBACK)


# -- parsing -----------------------------------------------------------------


def parse_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select(
        "event_id", "msec", "bucket", *BASE_KEYS, F.col("status").cast("int"), F.col("bytes_sent").cast("bigint"),
        "gzip_ratio", F.col("request_length").cast("bigint"), "request_time", "servers_contacted", "internal_redirects", "upstreams_servers",
    )


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = rejected(parse_lines(access_log(spark, sf_dir), BUCKET_DURATION))
    return skipped.select("event_id", F.col("value").alias("line"), "reason")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = rejected(parse_lines(access_log(spark, sf_dir), BUCKET_DURATION))
    return skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def upstream_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contact_rows(_requests(spark, sf_dir), "event_id")


def upstream_request_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.expr("array_join(transform(statuses, s -> concat(s.status, 'x', s.n)), ' ')")
    summary = request_summary(_requests(spark, sf_dir), "event_id").withColumn("statuses", shown)
    return summary.withColumns({f"{t}_us": F.col(f"{t}_us").cast("bigint") for t in TIMES})


def bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select("event_id", "msec", "bucket", _time())


def late_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of each line after a run that had reached 2024-01-15 00:00:00.5."""
    late_before = 1705276800.5 - BUCKET_DURATION * LOOKBACK
    parsed = parse_lines(access_log(spark, sf_dir), BUCKET_DURATION, late_before)
    return _outcomes(parsed)


def _outcomes(parsed: DataFrame, *keys: str) -> DataFrame:
    outcome = F.coalesce("reason", F.lit("accepted")).alias("outcome")
    return parsed.groupBy(*keys, outcome).agg(F.count(F.lit(1)).alias("lines"))


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = accepted(parse_lines(access_log_by_host(spark, sf_dir), BUCKET_DURATION))
    times = requests.select("source", F.col("msec").alias("last_msec"), F.lit(REQUEST).alias("kind"))
    return _marks(times)


def first_run_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline(access_log_by_host(spark, sf_dir), BUCKET_DURATION, LOOKBACK).drop("closed_through")


def input_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,500 lines of each of three logs, in blocks of 1,024 events."""
    return _outcomes(parse_lines(cap_lines(_placed(access_log_by_host(spark, sf_dir)), 2500), BUCKET_DURATION), "source")


def _placed(log: DataFrame) -> DataFrame:
    """Lines with a place: one file in blocks of 1,024 events."""
    return log.select(
        "source",
        "value",
        F.lit("events").alias("file"),
        F.floor(F.col("event_id") / 1024).alias("block"),
        F.col("event_id").alias("seq"),
    )


def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines written as text files and scanned back with the source taken from the path."""
    folder = shared_folder(spark, "log")
    access_log(spark, sf_dir).select("source", "value").write.partitionBy("source").text(folder)
    return (
        read_log(spark, folder, r"/source=([^/]+)/")
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters"))
    )


# -- metrics -----------------------------------------------------------------


def single_metric(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    values = metric(access_log(spark, sf_dir), name, BUCKET_DURATION)
    kind = "bigint" if METRICS[name].whole else "double"
    return values.select(_time(), *GRAIN_TAGS[METRICS[name].grain], F.col("value").cast(kind).alias("value"))


def all_base_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = metrics_wide(_partials(access_log(spark, sf_dir)))
    whole = {name: F.col(name).cast("bigint") for name in ("bytes_sent", "request_length_mean")}
    return wide.withColumns({"time": _time(), **whole}).drop("source", "bucket")


def per_contact_upstreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upstream metrics with every contact counted once, in one aggregate."""
    partials = partial_metrics(access_log(spark, sf_dir), BUCKET_DURATION, weighting="per_contact")
    sums = (
        partials.where("kind = 'contact'")
        .groupBy("source", "bucket", *BASE_KEYS, "upstream")
        .agg(*sums_of(*CONTACT_SUMS))
    )
    means = [F.expr(f"{METRICS[f'upstreams_{t}_time_mean'].value} AS {t}_time_mean") for t in TIMES]
    return sums.select(_time(), *BASE_KEYS, "upstream", F.col("contact_hits").alias("contacts"), *means)


def large_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of values near the largest 64-bit number, many in each bucket, as text and as points."""
    numbers = "9223372036854775000 - event_id % 1000, '|-|', 9000000000000 - event_id % 7"
    line = "concat('1|', unix_seconds(CAST(ts AS TIMESTAMP)), '|big|s|-|200|', " + numbers.replace("'|-|', ", "'|-|10|', ") + ", '|-|-|-|-|-')"
    lines = table(spark, sf_dir, "events").selectExpr("'big' AS source", f"{line} AS value")
    points = _points(lines).where("measurement IN ('bytes_sent', 'request_time_mean')")
    return points.select("measurement", "time", "value_i", F.round(F.col("value_d") / 1e9, 0).cast("bigint").alias("billions"))


def wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of numbers beyond 64 bits, and statuses beyond 32 bits, which stay texts; what is too long is scaled."""
    names = "'bytes_sent', 'status', 'request_length_mean', 'request_time_mean', 'upstreams_status', 'upstreams_response_time_mean', 'upstreams_connect_time_mean'"
    points = _points(wide_log(spark, sf_dir)).where(f"measurement IN ({names})")
    scaled = "bigint(round(value_d / CASE measurement WHEN 'bytes_sent' THEN 1e25D ELSE 1e9D END, 0)) AS scaled"
    return points.selectExpr("measurement", "time", "upstream", "status", "value_i", scaled)


def long_upstream_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three upstream metrics of lines with 1 to some thousand contacts each."""
    lines = supplier_log(spark, sf_dir)
    names = ("upstreams_hits", "upstreams_status", "upstreams_response_time_mean")
    parts = [
        metric(lines, name, ORDER_BUCKET_DURATION).selectExpr(
            f"'{name}' AS measurement", "vhost", "upstream",
            "status" if name == "upstreams_status" else "string(NULL) AS status", "double(value) AS value",
        )
        for name in names
    ]
    return parts[0].union(parts[1]).union(parts[2])


def order_contacts_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = flat_contact_means(order_contacts(spark, sf_dir))
    return means.withColumn("time", _day()).drop("bucket")


def order_contacts_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = flat_contact_statuses(order_contacts(spark, sf_dir))
    return hits.withColumn("time", _day()).drop("bucket")


# -- points and text ---------------------------------------------------------


def points_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(access_log(spark, sf_dir)).select("measurement", "time", *POINT_KEYS)


HOST_TAGS = {"host": "split_part(source, '/', 1)", "name": "source", "dc": "''"}


def points_static_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = with_tags(_points(access_log_by_host(spark, sf_dir)), tags_from(HOST_TAGS))
    pairs = "array_join(transform(array_sort(map_entries(tags)), e -> concat(e.key, '=', e.value)), ',')"
    return tagged.selectExpr("measurement", "time", f"{pairs} AS tags", f"{POINT_VALUE} AS value")


def line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(access_log_by_host(spark, sf_dir))
    return to_lines(points, HOST_TAGS, "m", BUCKET_DURATION).select("line")


def line_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in their order, in bodies of 500 but for the last."""
    bodies = batch_bodies(line_protocol(spark, sf_dir).orderBy("line"), 500)
    return bodies.select("number", "points", F.md5("body").alias("checksum"))


def field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shortest texts of fractions of up to 17 digits from 1e-300 to 1e300, and of plain ones."""
    digits = "concat(1 + event_id % 9, lpad(string(event_id * 104729 % 100000000), 8, '0'), lpad(string(event_id * 7919 % 100000000), 8, '0'))"
    wide = f"double(concat(CASE WHEN event_id % 2 = 0 THEN '-' ELSE '' END, substr({digits}, 1, int(1 + event_id % 17)), 'e', event_id * 13 % 585 - 300))"
    numbers = table(spark, sf_dir, "events").selectExpr("event_id", f"{wide} AS wide", "value / 7 AS plain")
    return numbers.selectExpr("event_id", f"{float_field('wide')} AS wide", f"{float_field('plain')} AS plain")


def measurement_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points written as a table and read back through one view per measurement."""
    folder = shared_folder(spark, "points")
    write_points(_points(access_log(spark, sf_dir)), folder)
    register_measurements(spark, folder, list(METRICS), prefix="points_of_")
    per_view = [
        f"SELECT measurement, count(value) AS points, min(value) AS lowest, max(value) AS highest "
        f"FROM points_of_{name} GROUP BY measurement"
        for name in METRICS
    ]
    return spark.sql(" UNION ALL ".join(per_view))


# -- runs and streams --------------------------------------------------------


def _hits(partials: DataFrame) -> DataFrame:
    return (
        partials.where(F.col("kind") == REQUEST)
        .groupBy("source", "bucket", *BASE_KEYS)
        .agg(F.sum("hits").alias("hits"), F.sum("bytes_sent").cast("bigint").alias("bytes_sent"))
        .select("source", _time(), *BASE_KEYS, "hits", "bytes_sent")
    )


def increment_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = _partials(access_log(spark, sf_dir))
    return _hits(closed_partials(partials, _marks(partials)))


def increment_closed_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = _partials(access_log_by_host(spark, sf_dir))
    return _hits(closed_partials(partials, _marks(partials)))


def increment_leftover(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = _partials(access_log(spark, sf_dir))
    return _hits(open_partials(partials, _marks(partials)))


def _published(points: DataFrame) -> DataFrame:
    return points.select("measurement", "time", *POINT_KEYS)


def increment_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines in two runs, before and from 2024-01-16; open buckets go over into the second."""
    events = table(spark, sf_dir, "events")
    runs = MetricsRuns(spark, shared_folder(spark, "runs"), RUN_OPTIONS)
    runs.run(access_log_of(spread(events.where("ts < TIMESTAMP_NTZ '2024-01-16 00:30:00'"), sf_dir)))
    runs.run(access_log_of(spread(events.where("ts >= TIMESTAMP_NTZ '2024-01-16 00:30:00'"), sf_dir)))
    return _published(runs.points())


def capped_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read by four runs over the same table, a third of the lines of each source at most: all lines once."""
    # written once, as each run reads its table several times, and dealt evenly: a run's lines lie next to each other
    # among the events, so few of their file splits would be all its work
    lines = written(_placed(by_host(access_log_of(spread(table(spark, sf_dir, "events"), sf_dir)))), "log")
    most = lines.groupBy("source").count().agg(F.max("count")).first()[0]
    options = RunOptions(BUCKET_DURATION, lookback_factor=1_000_000, skip_to_end=False, max_lines=-(-most // 3))
    runs = MetricsRuns(spark, shared_folder(spark, "runs"), options)
    for _ in range(4):
        runs.run(lines)
    return _hits(runs.leftover())


# A lookback that closes nothing, so that the runs' open buckets hold all lines.
_ALL_OPEN = RunOptions(BUCKET_DURATION, lookback_factor=1_000_000, skip_to_end=False)


def _following(spark: SparkSession) -> tuple[str, LogFiles, MetricsRuns]:
    folder = shared_folder(spark, "hosts")
    logs = LogFiles(f"{folder}/*/access.log*", r"/([^/]+)/access[.]log[^/]*$", r"[.]log[.](\d+)$")
    return folder, logs, MetricsRuns(spark, shared_folder(spark, "runs"), _ALL_OPEN)


def _share(events: DataFrame, high: float, low: float = 0.0) -> DataFrame:
    """The events between two parts of the event ids."""
    last = events.agg(F.max("event_id")).first()[0] or 0
    return events.where((F.col("event_id") <= last * high) & ((F.col("event_id") > last * low) | F.lit(low == 0)))


def rotated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines once, by runs between which logs are renamed, and then copied and truncated while lines come in."""
    folder, logs, runs = _following(spark)
    events = host_events(spark, sf_dir)
    write_logs(_share(events, 0.3), folder)
    runs.run(logs)
    rename_logs(spark, folder, "access.log", "access.log.1")
    write_logs(_share(events, 0.6, 0.3), folder)
    runs.run(logs)
    rename_logs(spark, folder, "access.log.1", "access.log.2")
    write_logs(_share(events, 0.8, 0.3), folder, "access.log.1")
    write_logs(_share(events, 1.0, 0.8), folder)
    runs.run(logs)
    return _hits(runs.leftover())


def growing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines once, by runs over logs that grow, and one over logs that did not."""
    folder, logs, runs = _following(spark)
    events = host_events(spark, sf_dir)
    for part in (0.2, 0.5, 0.5, 1.0):
        write_logs(_share(events, part), folder)
        runs.run(logs)
    runs.run(logs)
    return _hits(runs.leftover())


def torn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines once, by runs over logs whose last line is still being written: what there is of it is not read."""
    folder, logs, runs = _following(spark)
    events = host_events(spark, sf_dir)
    line = f"concat('1', substr({log_line()}, 2))"
    # each line end is written with the first character of the next line, which all begin alike
    firsts = events.groupBy(F.col("source").alias("host")).agg(F.min("event_id").alias("first"))
    torn, torn_line = events.join(F.broadcast(firsts), F.expr("source <=> host")), f"substr({line}, IF(event_id > first, 2, 1))"
    for part in (0.3, 0.7):
        write_logs(_share(torn, part), folder, end="\n1", value=torn_line)
        runs.run(logs)
    write_logs(events, folder, value=line)
    runs.run(logs)
    return _hits(runs.leftover())


def run_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines that a run keeps."""
    options = RunOptions(BUCKET_DURATION, LOOKBACK, skip_to_end=False, keep_rejects=True)
    runs = MetricsRuns(spark, shared_folder(spark, "runs"), options)
    runs.run(access_log(spark, sf_dir))
    return runs.rejects().select("source", F.col("value").alias("line"), "reason")


def merged_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of three runs, those of the first two merged by day, the others fresh."""
    events = table(spark, sf_dir, "events")
    runs = MetricsRuns(spark, shared_folder(spark, "runs"), RUN_OPTIONS)
    times = ["2024-01-08 00:30:00", "2024-01-16 00:30:00", "9999-01-01 00:00:00"]
    for since, until in zip(["0001-01-01 00:00:00", *times], times):
        runs.run(access_log_of(events.where(f"ts >= TIMESTAMP_NTZ '{since}' AND ts < TIMESTAMP_NTZ '{until}'")))
        if until != times[-1]:
            runs.merge_points()
    return _published(runs.points())


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines that runs driven by a stream of files keep."""
    folder = shared_folder(spark, "stream-rejects")
    options = RunOptions(BUCKET_DURATION, LOOKBACK, skip_to_end=False, keep_rejects=True)
    runs = MetricsRuns(spark, f"{folder}/state", options)
    stream_runs(_event_stream(spark, sf_dir), runs, f"{folder}/checkpoint").awaitTermination()
    return runs.rejects().select("source", F.col("value").alias("line"), "reason")


def increment_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skipped lines per reason of a second run that gets lines of closed buckets, and of a source met late."""
    events = table(spark, sf_dir, "events")
    runs = MetricsRuns(spark, shared_folder(spark, "runs"), RunOptions(BUCKET_DURATION, LOOKBACK, skip_to_end=True))
    first = access_log_of(spread(events.where("ts < TIMESTAMP_NTZ '2024-01-20 00:30:00'"), sf_dir))
    second = access_log_of(spread(events.where("ts >= TIMESTAMP_NTZ '2024-01-16 00:30:00'"), sf_dir))
    runs.run(first)
    runs.run(second.union(second.withColumn("source", F.lit("met.late"))))
    return skip_counts(runs.partials(runs.last_commit().slot))


def start_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the runs after a start over, which knows nothing of the runs before."""
    folder = shared_folder(spark, "runs")
    MetricsRuns(spark, folder, RUN_OPTIONS).run(access_log_by_host(spark, sf_dir))
    MetricsRuns(spark, folder, RUN_OPTIONS, start_over=True).run(access_log(spark, sf_dir))
    return _published(MetricsRuns(spark, folder, RUN_OPTIONS).points())


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # a pattern, because a stream takes a plain path for a folder and the table may be one file
    return access_log_of(spread(spark.readStream.schema(schema).parquet(f"{sf_dir}/events[.]parquet"), sf_dir))


def stream_closed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the buckets that the watermark closes."""
    folder = shared_folder(spark, "stream")
    start_closed_buckets(_event_stream(spark, sf_dir), folder, RUN_OPTIONS).awaitTermination()
    return _published(closed_bucket_points(spark, folder))


def stream_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the micro-batches of the watermark form tell of their lines, as statistics; they come beside the stream."""
    folder, seen = shared_folder(spark, "stream-stats"), []
    stream = start_closed_buckets(_event_stream(spark, sf_dir), folder, RUN_OPTIONS, stats_sink=lambda frame: seen.append(frame.collect()[0]))
    stream.awaitTermination()
    batches = sum(p.observedMetrics.get("lines") is not None for p in stream.recentProgress)
    for _ in range(300):
        if len(seen) >= batches:
            break
        time.sleep(0.1)
    stats = spark.createDataFrame(seen, STATS_SCHEMA)
    return stats.agg(F.sum("parsed_lines").alias("parsed_lines"), F.sum("skipped_lines").alias("skipped_lines"))


def streamed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of incremental runs driven by a stream of files."""
    folder = shared_folder(spark, "stream-runs")
    runs = MetricsRuns(spark, f"{folder}/state", RUN_OPTIONS)
    stream_runs(_event_stream(spark, sf_dir), runs, f"{folder}/checkpoint").awaitTermination()
    return _published(runs.points())


# Until when each source's lines come first, and from when on they come next.
_SLOW_AND_FAST = {"fast": ("2024-01-25 00:30:00", "2024-01-24 00:30:00"), "slow": ("2024-01-10 00:30:00", "2024-01-08 00:30:00")}


def stream_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hits and skipped lines of a slow and a fast source in one stream, each with its own mark, in two steps."""
    folder = shared_folder(spark, "stream-sources")
    events = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    for step, when in enumerate(("ts < TIMESTAMP_NTZ '{0}'", "ts >= TIMESTAMP_NTZ '{1}'")):
        for source, times in _SLOW_AND_FAST.items():
            lines = access_log_of(events.where(when.format(*times))).select(F.lit(source).alias("source"), "value")
            lines.write.mode("append").parquet(f"{folder}/lines")
        arriving = spark.readStream.schema("source string, value string").parquet(f"{folder}/lines")
        start_by_source(arriving, f"{folder}/out", RUN_OPTIONS).awaitTermination()
    hits = closed_bucket_points(spark, f"{folder}/out").where("measurement = 'hits'")
    skipped = skipped_by_source(spark, f"{folder}/out")
    none = [f"string(NULL) AS {c}" for c in ("time", *BASE_KEYS)]
    return hits.selectExpr("source", "'hits' AS what", "time", *BASE_KEYS, "value_i AS n").union(
        skipped.selectExpr("source", "reason AS what", *none, "lines AS n")
    )


def _daily_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as sends of one day each."""
    return _points(access_log(spark, sf_dir)).withColumn("run", F.ceil(F.col("bucket") / 24))


def outbox_retain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All daily sends failed; the newest ten are kept."""
    sends = written(_daily_sends(spark, sf_dir), "sends")
    return retained(sends, 10).groupBy("run", "measurement").agg(F.count(F.lit(1)).alias("points"))


def outbox_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day's send goes out together with the ten retained ones before it."""
    sends = written(_daily_sends(spark, sf_dir), "sends")
    newest = sends.agg(F.max("run")).scalar()
    saved, new = sends.where(F.col("run") < newest), sends.where(F.col("run") == newest)
    return replayed(saved, new, 10).groupBy("run", "resent").agg(F.count(F.lit(1)).alias("points"))


def replayed_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that the store got, as bodies, when the first delivery arrives but is not acknowledged and so repeated."""
    events = table(spark, sf_dir, "events")
    got = spark.sparkContext.accumulator(0)
    once = SendOnce(spark, shared_folder(spark, "ledger"), lambda body: got.add(body.count("\n")), lambda points: to_lines(points, HOST_TAGS))
    broken = [True]

    def sink(points: DataFrame) -> None:
        once(points)
        if broken.pop() if broken else False:
            raise OSError("the answer is lost")

    runs = MetricsRuns(spark, shared_folder(spark, "runs"), RUN_OPTIONS, sink)
    runs.run(access_log_of(events.where("ts < TIMESTAMP_NTZ '2024-01-16 00:30:00'")))
    stats = runs.run(access_log_of(events.where("ts >= TIMESTAMP_NTZ '2024-01-16 00:30:00'")))
    return spark.createDataFrame([(got.value, once.sent, stats.sent_points + stats.resent_points)], "got bigint, listed bigint, delivered bigint")


def _one_run(spark: SparkSession, sf_dir: str):
    runs = MetricsRuns(spark, shared_folder(spark, "runs"), RUN_OPTIONS)
    return runs, runs.run(access_log(spark, sf_dir))


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of one run; its clock times are left out."""
    _, stats = _one_run(spark, sf_dir)
    return stats_frame(spark, stats).select("parsed_lines", "skipped_lines", "sent_points", "resent_points")


def run_stats_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a line, stamped with the end of the last bucket instead of the clock."""
    runs, stats = _one_run(spark, sf_dir)
    counts = stats_frame(spark, stats).select("parsed_lines", "skipped_lines", "sent_points")
    last = runs.marks(runs.last_commit().slot).agg((F.max("closed_through") + LOOKBACK) * BUCKET_DURATION).scalar()
    tags = static_tags({"host": "web1"}, name_from_source=False)
    return stats_lines(counts.withColumn("epoch", last.cast("double")), tags, "m").select("line")


QUERIES: dict[str, Query] = {
    "parse_accepted": parse_accepted,
    "parse_rejects": parse_rejects,
    "reject_reasons": reject_reasons,
    "upstream_contacts": upstream_contacts,
    "upstream_request_summary": upstream_request_summary,
    "bucket_assign": bucket_assign,
    "late_filter": late_filter,
    "high_water_mark": high_water_mark,
    "first_run_baseline": first_run_baseline,
    "input_cap": input_cap,
    "log_scan": log_scan,
    **{name: partial(single_metric, name) for name in METRICS},
    "metrics_wide": all_base_metrics,
    "per_contact_upstreams": per_contact_upstreams,
    "large_sums": large_sums,
    "wide_numbers": wide_numbers,
    "field_texts": field_texts,
    "long_upstream_lists": long_upstream_lists,
    "order_contacts_means": order_contacts_means,
    "order_contacts_status": order_contacts_status,
    "points_long": points_long,
    "points_static_tags": points_static_tags,
    "line_protocol": line_protocol,
    "batch_bodies": line_batches,
    "measurement_readback": measurement_readback,
    "increment_closed": increment_closed,
    "increment_closed_by_source": increment_closed_by_source,
    "increment_leftover": increment_leftover,
    "increment_two_runs": increment_two_runs,
    "increment_late": increment_late,
    "capped_runs": capped_runs,
    "rotated_runs": rotated_runs,
    "growing_log": growing_log,
    "torn_lines": torn_lines,
    "run_rejects": run_rejects,
    "stream_rejects": stream_rejects,
    "merged_points": merged_points,
    "start_over_runs": start_over_runs,
    "stream_closed_buckets": stream_closed_buckets,
    "stream_run_stats": stream_run_stats,
    "stream_runs": streamed_runs,
    "stream_sources": stream_sources,
    "outbox_retain": outbox_retain,
    "outbox_replay": outbox_replay,
    "replayed_delivery": replayed_delivery,
    "run_stats": run_stats,
    "run_stats_line": run_stats_line,
}
