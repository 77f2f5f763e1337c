"""Logs followed from run to run: only files that changed are opened, and each line is read once.

A log is known by the lines it begins with, not by its path, so it is found again after it was renamed, copied
or compressed, and a new file under an old name is a new log.  How many of its lines are done is kept per log.  An
unfinished last line stays undone until its end is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyweir.sources.logs import placed_lines, rotated, source_name, take_blocks

#: Lines that a log is known by.
HEAD_LINES = 32
#: Lines of a file split that are counted together.
CELL_LINES = 4096
#: Runs after which a log that is seen no more is forgotten; a file may be out of sight while it is renamed.
KEPT_RUNS = 24
FILES_SCHEMA = (
    "source string, file string, size bigint, modified timestamp, done bigint, head_lines int, head bigint, unseen int"
)
# Files whose size says nothing about their lines; they are complete when they appear.
_PACKED = r"[.](gz|gzip|bz2|zst|zstd|lz4|snappy|deflate|xz)$"
# What a byte order mark at the beginning takes, which the reader drops.
_MARK_BYTES = 3


@dataclass(frozen=True)
class LogFiles:
    """Text files, by paths or patterns, as logs to follow.

    ``source_pattern`` and ``rotation`` are as in ``read_log``: files of one log belong to one source, and the
    order among rotated ones is by their number, the highest first, then by the time of their last change.
    """

    paths: str | list[str]
    source_pattern: str | None = None
    rotation: str | None = None

    def listed(self, spark: SparkSession) -> DataFrame:
        """``file``, ``size``, ``modified`` of all files; none is opened."""
        paths = [self.paths] if isinstance(self.paths, str) else self.paths
        return spark.read.format("binaryFile").load(paths).select(*_facts(*_FILE))

    def lines(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """The lines of the given files with their places; the others are not opened."""
        text = spark.read.option("lineSep", "\n").text(self.paths)
        return placed_lines(text.where(F.col("_metadata.file_path").isin(files)), self.source_pattern, self.rotation, *_facts("size", "modified"))

    def named(self, files: DataFrame) -> DataFrame:
        """Files with the source and the age that their lines have."""
        return files.withColumns({"source": source_name(self.source_pattern, F.col("file")), "age": rotated(self.rotation, F.col("file"))})


_FILE = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}


def _facts(*names: str) -> list[Column]:
    return [F.col(f"_metadata.{_FILE[name]}").alias(name) for name in names]


def follow(spark: SparkSession, logs: LogFiles, before: DataFrame, folder: str, max_lines: int = 0) -> DataFrame:
    """``source``, ``value`` of the lines that are not done; the state after them goes to ``folder``/files.

    ``before`` is the state after the last run, by ``FILES_SCHEMA``.  Of each source the first ``max_lines`` lines
    come, 0 for all.  Tables in ``folder`` have a row per file or file split, not per line.
    """
    listed = _kept(logs.listed(spark), f"{folder}/listed")
    same = ["file", "size", "modified"]
    changed = [r.file for r in listed.join(before, same, "left_anti").select("file").collect()]
    lines = logs.lines(spark, changed)
    seen = _kept(_begun(logs, lines), f"{folder}/seen")
    plan = _kept(_planned(_matched(seen, before), max_lines), f"{folder}/plan")
    _kept(_state(plan, before, listed), f"{folder}/files")
    whole = [r.file for r in plan.where("done = 0 AND take = lines").select("file").collect()]
    parts = [r.file for r in plan.where("take > 0 AND NOT (done = 0 AND take = lines)").select("file").collect()]
    return logs.lines(spark, whole).select("source", "value").union(_parts(logs.lines(spark, parts), plan, folder) if parts else lines.limit(0).select("source", "value"))


def _kept(frame: DataFrame, path: str) -> DataFrame:
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _begun(logs: LogFiles, lines: DataFrame) -> DataFrame:
    """Per file its lines, how many of them have ended, and hashes of its first 1, 2, ... lines."""
    # by file alone; its name gives source and age afterwards, not once for each line
    counts = lines.groupBy("file").agg(
        F.max("size").alias("size"), F.max("modified").alias("modified"), F.count("*").alias("lines"), F.expr("sum(octet_length(value) + 1L)").alias("bytes")
    )
    counts = logs.named(counts)
    # a last line without its end counts for a byte more than there is; if the file grew meanwhile, for more
    ended = f"file RLIKE r'{_PACKED}' OR bytes = size OR bytes = size - {_MARK_BYTES}"
    counts = counts.selectExpr("*", f"IF({ended}, lines, lines - 1) AS complete")
    # a group limit, which Spark applies before the shuffle: a few rows per file leave their task
    number = F.row_number().over(Window.partitionBy("file").orderBy("seq"))
    first = lines.where("block = 0").select("file", "seq", F.xxhash64("value").alias("h")).withColumn("n", number).where(f"n <= {HEAD_LINES}")
    heads = first.groupBy("file").agg(F.expr("transform(sort_array(collect_list(struct(n, h))), e -> e.h)").alias("h"))
    heads = heads.selectExpr("file", "transform(sequence(1, size(h)), i -> xxhash64(array_join(slice(h, 1, i), ','))) AS heads")
    return counts.join(heads, "file", "left").selectExpr("source", "file", "size", "modified", "age", "lines", "complete", "coalesce(heads, array()) AS heads")


def _matched(seen: DataFrame, before: DataFrame) -> DataFrame:
    """Each file with the lines of its log that are done: those of the known log that it begins with and goes beyond."""
    known = before.where("head_lines > 0").select("source", "head_lines", "head", "done")
    begins = seen.selectExpr("source", "file", "complete", "posexplode(heads) AS (i, head)").selectExpr("source", "file", "complete", "i + 1 AS head_lines", "head")
    found = begins.join(known, ["source", "head_lines", "head"]).where("done <= complete AND head_lines <= complete")
    best = found.groupBy("file").agg(F.max(F.struct("done", "head_lines", "head")).alias("known"))
    # files that begin with the same lines are one log: the known one, or a new one that is already seen twice
    whole = f"IF(complete >= {HEAD_LINES}, get(heads, {HEAD_LINES - 1}), NULL)"
    named = f"coalesce(string(known), 'lines ' || {whole}, 'file ' || file) AS log"
    return seen.join(best, "file", "left").selectExpr(*seen.columns, "coalesce(known.done, 0L) AS before", named)


def _planned(files: DataFrame, max_lines: int) -> DataFrame:
    """How many lines of each file are done and how many come next; of files of one log, the longest gives them."""
    same = Window.partitionBy("source", "log").orderBy(F.desc("complete"), F.desc("modified"), "file")
    files = files.withColumn("leads", F.row_number().over(same) == 1)
    files = files.withColumn("done", F.expr("IF(leads, before, complete)")).withColumn("next", F.expr("complete - done"))
    order = Window.partitionBy("source").orderBy(F.desc("age"), "modified", "file").rowsBetween(Window.unboundedPreceding, 0)
    room = F.lit(max_lines) - (F.sum("next").over(order) - F.col("next")) if max_lines else F.col("next")
    files = files.withColumn("take", F.least(F.col("next"), F.greatest(room, F.lit(0).cast("bigint"))))
    return files.select("source", "file", "size", "modified", "age", "lines", "complete", "heads", "before", "done", "take", "log")


def _state(plan: DataFrame, before: DataFrame, listed: DataFrame) -> DataFrame:
    """The state after the planned lines.

    A file whose lines are all done is not opened again before it changes.  A log that was found elsewhere is
    known there from now on; one that was not found is remembered for some runs.
    """
    # copies of a log that still has lines to come are as far as the log
    reached = plan.groupBy("source", "log").agg(F.max(F.expr("IF(done < complete, done + take, NULL)")).alias("reached"))
    after = plan.join(reached, ["source", "log"]).selectExpr(
        "*", "IF(done < complete, done + take, least(complete, coalesce(reached, complete))) AS now"
    )
    after = after.selectExpr(
        "source", "file", "IF(now = complete, size, -1L) AS size", "modified", "now AS done",
        # the first split of a file may hold fewer lines
        f"int(least(now, {HEAD_LINES}L, size(heads))) AS head_lines",
        f"get(heads, int(least(now, {HEAD_LINES}L, size(heads))) - 1) AS head", "0 AS unseen",
    )
    same = ["file", "size", "modified"]
    unchanged = before.join(listed, same, "left_semi").withColumn("unseen", F.lit(0))
    moved = plan.where("before > 0").select("source", F.explode("heads").alias("head"))
    gone = before.join(listed, same, "left_anti").where("head_lines > 0").join(moved, ["source", "head"], "left_anti")
    gone = gone.withColumns({"size": F.lit(-1).cast("bigint"), "unseen": F.col("unseen") + 1}).where(f"unseen <= {KEPT_RUNS}")
    columns = [c.split()[0] for c in FILES_SCHEMA.split(", ")]
    return after.select(columns).union(unchanged.select(columns)).union(gone.select(columns))


def _parts(lines: DataFrame, plan: DataFrame, folder: str) -> DataFrame:
    """The lines after those that are done, of files that are not taken whole.

    A block is counted by cells of its lines, so only one cell is numbered where a file goes on, not a block.
    """
    lines = lines.withColumn("cell", F.expr(f"seq div {CELL_LINES}"))
    counts = lines.groupBy("file", "block", "cell").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("file").orderBy("block", "cell").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("start", F.sum("n").over(so_far) - F.col("n"))
    placed = counts.join(plan.selectExpr("file", "done", "done + take AS end"), "file")
    blocks = _kept(
        placed.selectExpr("file", "block", "cell", "n", *[f"least(n, greatest(0L, {at} - start)) AS {name}" for at, name in (("done", "low"), ("end", "high"))]),
        f"{folder}/blocks",
    )
    return take_blocks(lines, blocks).select("source", "value")
