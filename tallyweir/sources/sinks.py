"""Where points and lines go: tables, text files, or the caller's own sender."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweir.operators.points import POINT_VALUE
from tallyweir.sources.scratch import written

DEFAULT_BATCH_SIZE = 500


def write_points(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A table in one folder per measurement; the hint evens out file sizes, splitting large measurements."""
    points.hint("rebalance", "measurement").write.mode(mode).partitionBy("measurement").parquet(path)


def register_measurements(spark: SparkSession, path: str, measurements: list[str], prefix: str = "") -> None:
    """One view per measurement over a points table, to be queried by name; each reads its own folder only."""
    points = spark.read.parquet(path)
    for name in measurements:
        view = points.where(F.col("measurement") == name).selectExpr("*", f"{POINT_VALUE} AS value")
        view.createOrReplaceTempView(prefix + name)


def write_lines(lines: DataFrame, path: str, batch_size: int = DEFAULT_BATCH_SIZE, mode: str = "overwrite") -> None:
    """Text files of at most ``batch_size`` lines, each line ended; no limit if it is 0 or less."""
    lines.select("line").write.mode(mode).option("maxRecordsPerFile", max(batch_size, 0)).text(path)


def batch_bodies(lines: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """``number``, ``points``, ``body``: ended lines in bodies that all but the last hold ``batch_size``, in the order of the lines.

    Lines are written once with their places; what is before each partition is known from one count per partition.
    A body whose lines lie in two partitions is put together from its parts, all others leave their task whole.
    """
    if batch_size < 1:
        raise ValueError(f"a body holds one line at least: {batch_size}")
    placed = written(lines.select("line", F.monotonically_increasing_id().alias("place")), "lines")
    sizes = placed.groupBy(F.expr(f"shiftright(place, {_PLACE_BITS})").alias("part")).agg(F.count("*").alias("n")).collect()
    # a number per partition of the lines
    before, total = {}, 0
    for part, n in sorted(sizes):
        before[part] = total
        total += n

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, waiting = -1, 0, []
        for batch in batches:
            rows = []
            for line, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = before[place >> _PLACE_BITS] + (place & (1 << _PLACE_BITS) - 1)
                if at // batch_size != number or at != first + len(waiting):
                    if waiting:
                        rows.append((number, first, waiting))
                    number, first, waiting = at // batch_size, at, []
                waiting.append(line)
            yield _bodies(rows)
        yield _bodies([(number, first, waiting)] if waiting else [])

    filled = written(placed.mapInArrow(fill, "number bigint, first bigint, points bigint, body string"), "bodies")
    whole = f"points = {batch_size} OR number = {total // batch_size} AND points = {total % batch_size}"
    parts = filled.where(f"NOT ({whole})").groupBy("number").agg(
        F.sum("points").alias("points"), F.expr("array_join(transform(sort_array(collect_list(struct(first, body))), p -> p.body), '') AS body")
    )
    return filled.where(whole).select("number", "points", "body").union(parts)


# Bits of a place that count the rows of a partition.
_PLACE_BITS = 33


def _bodies(rows: list[tuple[int, int, list[str]]]) -> pa.RecordBatch:
    columns = [r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows], ["\n".join(r[2]) + "\n" for r in rows]
    types = pa.int64(), pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["number", "first", "points", "body"])


def send_lines(lines: DataFrame, send: Callable[[str], None], batch_size: int = DEFAULT_BATCH_SIZE) -> None:
    """Call ``send(body)`` on the executors for each body; a failing call fails its task, and Spark retries it."""

    def send_all(rows: Iterator) -> None:
        for row in rows:
            send(row["body"])

    batch_bodies(lines, batch_size).select("body").foreachPartition(send_all)
