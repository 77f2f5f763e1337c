"""Closed buckets by watermark: state in Spark's state store, one row per open key.

The watermark sits on the right edge of the bucket and trails by the lookback,
so a bucket closes when the stream has reached ``lookback_factor`` buckets
beyond it.  It is one watermark for all sources; where a slow source must not
lose lines to a fast one, use ``runs``, which keeps a mark per source.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyweir.functions.buckets import bucket_end
from tallyweir.operators.partials import PARTIAL_KEYS, SUMS, contributions_of, sums_of, with_source
from tallyweir.operators.points import POINT_SCHEMA, points_from_partials
from tallyweir.operators.requests import parse_lines
from tallyweir.operators.runstats import RunStats, stats_frame
from tallyweir.options import RunOptions
from tallyweir.sources.sinks import write_points

log = logging.getLogger(__name__)

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def closed_bucket_stream(lines: DataFrame, options: RunOptions) -> DataFrame:
    """Streaming partials of closed buckets, for append mode.

    Counts of parsed and skipped lines are observed as ``lines``; a repeated task may
    raise them, so they inform but do not bill.
    """
    parsed = parse_lines(with_source(lines), options.bucket_duration)
    if options.max_ahead is not None:
        # one clock that is wrong must not close the buckets of all
        ahead = f"msec > unix_seconds(current_timestamp()) + {options.max_ahead}"
        parsed = parsed.withColumn("reason", F.expr(f"CASE WHEN reason IS NULL AND {ahead} THEN 'future' ELSE reason END"))
    observed = parsed.observe(
        "lines",
        F.count(F.lit(1)).alias("parsed_lines"),
        F.count("reason").alias("skipped_lines"),
    )
    rows = contributions_of(observed, options.weighting, skips=False)
    delay = f"{options.lookback_factor * options.bucket_duration} seconds"
    keys = [name for name in PARTIAL_KEYS if name != "bucket"]
    return (
        rows.selectExpr("*", f"{bucket_end('bucket', options.bucket_duration)} AS bucket_end")
        .withWatermark("bucket_end", delay)
        .groupBy("bucket_end", *keys)
        .agg(*sums_of(*SUMS))
        .selectExpr("*", f"unix_seconds(bucket_end) div {options.bucket_duration} AS bucket")
    )


def start_closed_buckets(
    lines: DataFrame,
    folder: str,
    options: RunOptions,
    sink: Callable[[DataFrame, int], None] | None = None,
    every: str | None = None,
    stats_sink: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Publish the points of closed buckets to ``folder/points/batch=N`` and to ``sink``.

    ``stats_sink`` gets the statistics of each micro-batch as a frame of one row, as from runs; it is called when
    the batch is done, on the driver and beside the stream, so it may come a little later.

    A micro-batch is written under its own number, so a repeated batch replaces
    its first attempt.  Without ``every`` the stream takes what is there and ends.
    Options that only ``MetricsRuns`` knows are refused.
    """
    other = {"skip_to_end": options.skip_to_end, "max_lines": options.max_lines, "keep_rejects": options.keep_rejects, "outbox_limit": options.outbox_limit is not None}
    if any(other.values()):
        raise ValueError(f"not for this form of stream: {', '.join(name for name, used in other.items() if used)}")
    spark = lines.sparkSession
    folder = folder.rstrip("/")
    pin_options(spark, f"{folder}/options", options)

    def publish(batch: DataFrame, batch_id: int) -> None:
        # written first: the points read the partials more than once
        path = f"{folder}/partials/batch={batch_id}"
        batch.drop("bucket_end").write.mode("overwrite").parquet(path)
        partials = batch.sparkSession.read.schema(batch.drop("bucket_end").schema).parquet(path)
        points = points_from_partials(partials, options.bucket_duration)
        target = f"{folder}/points/batch={batch_id}"
        write_points(points, target)
        if sink is not None:
            sink(batch.sparkSession.read.schema(POINT_SCHEMA).parquet(target), batch_id)

    name = f"closed-buckets-{uuid.uuid4().hex}"
    if stats_sink is not None:
        spark.streams.addListener(BatchStats(spark, name, stats_sink))
    writer = (
        closed_bucket_stream(lines, options)
        .writeStream.outputMode("append")
        .queryName(name)
        .foreachBatch(publish)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with state_on_disk(spark):
        return writer.start()


class BatchStats(StreamingQueryListener):
    """Sends the statistics of the micro-batches of one stream, from what it has observed, until it ends."""

    def __init__(self, spark: SparkSession, name: str, send: Callable[[DataFrame], None]) -> None:
        self.spark, self.name, self.send, self.own = spark, name, send, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.own = event.runId

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get("lines")
        if progress.name != self.name or seen is None:
            return
        ended = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp() + progress.batchDuration / 1000
        seconds, parsing = progress.batchDuration / 1000, progress.durationMs.get("addBatch", 0) / 1000
        stats = RunStats.measured(progress.batchId, ended, seconds, parsing, seen["parsed_lines"], seen["skipped_lines"], 0, 0)
        try:
            self.send(stats_frame(self.spark, stats))
        except Exception as error:  # whatever the caller's sink raises, the stream goes on
            log.warning("statistics not delivered: %s", error)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.own:
            self.spark.streams.removeListener(self)


def closed_bucket_points(spark: SparkSession, folder: str) -> DataFrame:
    """All points published to ``folder`` so far, with the number of their ``batch``."""
    return spark.read.schema(f"{POINT_SCHEMA}, batch bigint").parquet(f"{folder.rstrip('/')}/points")


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Start a query with the state store that spills to disk, unless the session chose one."""
    if spark.conf.get(_STATE_STORE, None) not in (None, "") and "HDFSBacked" not in spark.conf.get(_STATE_STORE):
        yield
        return
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKS_DB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, before)


def pin_options(spark: SparkSession, path: str, options: RunOptions) -> None:
    """Keep the options beside the checkpoint and refuse others: its state was built with them."""
    try:
        pinned = json.loads(spark.read.text(path).head()["value"])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        mine = {
            "bucket_duration": options.bucket_duration,
            "lookback_factor": options.lookback_factor,
            "weighting": options.weighting,
        }
        spark.createDataFrame([(json.dumps(mine),)], "value string").coalesce(1).write.text(path)
        return
    options.check_against(pinned["bucket_duration"], pinned["lookback_factor"], pinned["weighting"])
