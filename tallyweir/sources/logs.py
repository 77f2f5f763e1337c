"""Log lines from text files, in batches and as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamReader


def source_name(pattern: str | None = None, path: Column | None = None) -> Column:
    """Identity of the log a line comes from: its path, or group 1 of ``pattern`` in it.

    Rotated files of one log need a pattern that leaves out the rotation, or
    each file counts as a log of its own.
    """
    path = F.col("_metadata.file_path") if path is None else path
    return path if pattern is None else F.regexp_extract(path, pattern, 1)


def rotated(rotation: str | None, path: Column) -> Column:
    """How often the file was rotated, by group 1 of ``rotation`` in its path; 0 if that is no number."""
    return F.lit(0) if rotation is None else F.coalesce(F.regexp_extract(path, rotation, 1).try_cast("int"), F.lit(0))


PLACE = ("file", "block", "seq")
POSITIONS_SCHEMA = "source string, file string, done bigint"


def read_log(
    spark: SparkSession, paths: str | list[str], source_pattern: str | None = None, rotation: str | None = None
) -> DataFrame:
    """``source``, ``value`` and the place of the line: ``file``, ``age``, ``block``, ``seq``.

    ``block`` is the offset of the file split, ``seq`` grows with the lines inside it.  ``rotation`` is a
    pattern whose group 1 is the number of a rotated file, as ``\\.log\\.(\\d+)$``; the highest is the oldest.
    """
    return placed_lines(spark.read.option("lineSep", "\n").text(paths), source_pattern, rotation)


def placed_lines(text: DataFrame, source_pattern: str | None = None, rotation: str | None = None, *more: Column) -> DataFrame:
    """Lines of a text table with their source, their place and ``more`` columns about their file."""
    return text.select(
        source_name(source_pattern).alias("source"),
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        *more,
        rotated(rotation, F.col("_metadata.file_path")).alias("age"),
    )


def stream_log(
    spark: SparkSession,
    path: str,
    source_pattern: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """``source`` and ``value`` of the lines of new files; a file must be complete when it appears."""
    reader: DataStreamReader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path).select(source_name(source_pattern).alias("source"), "value")


def has_place(lines: DataFrame) -> bool:
    return {"source", *PLACE} <= set(lines.columns)


def next_blocks(lines: DataFrame, max_lines: int = 0, positions: DataFrame | None = None) -> DataFrame:
    """Which lines of each block come next: ``source``, ``file``, ``block``, ``n``, and the range ``low`` to ``high``.

    ``positions`` tells how many lines of each file are done, which stays true while a file grows, however
    Spark splits it.  Of the others, the first ``max_lines`` of each source come next, older files first and
    equally old ones by name (``age``, if there is such a column, tells how often a file was rotated); 0 for all.
    """
    missing = {"source", *PLACE} - set(lines.columns)
    if missing:
        raise ValueError(f"this needs the place of each line, as read_log gives it; missing: {sorted(missing)}")
    age = "age" if "age" in lines.columns else "0"
    counts = lines.selectExpr("source", "file", f"{age} AS age", "block").groupBy("source", "file", "age", "block").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("source", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("start", F.sum("n").over(so_far) - F.col("n"))
    if positions is None:
        placed = placed.withColumn("low", F.lit(0).cast("bigint"))
    else:
        placed = placed.join(positions, ["source", "file"], "left").withColumn(
            "low", F.expr("least(n, greatest(0L, coalesce(done, 0L) - start))")
        )
    in_order = Window.partitionBy("source").orderBy(F.desc("age"), "file", "block").rowsBetween(Window.unboundedPreceding, 0)
    room = F.lit(max_lines) - (F.sum(F.expr("n - low")).over(in_order) - F.expr("n - low")) if max_lines else F.col("n")
    return placed.withColumn("high", F.expr("low") + F.least(F.expr("n - low"), F.greatest(room, F.lit(0)))).select(
        "source", "file", "block", "n", "low", "high"
    )


def advanced(positions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Positions after the lines of ``next_blocks`` are done."""
    taken = blocks.groupBy("source", "file").agg(F.sum(F.expr("high - low")).alias("done"))
    return positions.unionByName(taken).groupBy("source", "file").agg(F.sum("done").alias("done"))


def take_blocks(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The lines in the ranges of ``next_blocks``.

    Blocks taken whole pass as they are; only those that a range cuts are numbered line by line, so no sort
    or task ever holds more than a block.  A compressed log is one block, unless blocks are divided by ``cell``.
    """
    keys = [name for name in ("source", "file", "block", "cell") if name in blocks.columns]
    whole = lines.join(blocks.where("low = 0 AND high = n").select(*keys), keys, "left_semi")
    cut = lines.join(blocks.where("low < high AND high - low < n").select(*keys, "low", "high"), keys)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("seq"))
    part = cut.withColumn("_number", number).where("_number > low AND _number <= high").select(*lines.columns)
    return whole.select(*lines.columns).unionByName(part)


def cap_lines(lines: DataFrame, max_lines: int) -> DataFrame:
    """The first ``max_lines`` lines of each source in the order of their places; 0 for all."""
    return take_blocks(lines, next_blocks(lines, max_lines)) if max_lines else lines
