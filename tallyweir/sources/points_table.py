"""Published points of many runs, merged into few files per day, beside those of the newest runs.

Runs write a folder each.  Merging puts their points with those of the same days that were merged before into one file
per day and measurement (more only where that would be too large), ordered by time.  A manifest names the folder of
every day; it is replaced as a whole by one small file, so readers see all of a merge or nothing, and a merge that dies
changes nothing.  Folders that a merge replaced are deleted by the next one, when no reader of the old manifest is left.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tallyweir.operators.points import POINT_SCHEMA

DAY = 86_400
MANIFEST_SCHEMA = "version bigint, state bigint, through bigint, days map<string, string>, replaced array<string>"
_COLUMNS = [c.split()[0] for c in POINT_SCHEMA.split(", ")]


class PointsTable:
    """Points under ``root``/state=E/run=N, and merged ones under ``root``-merged."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.merged = spark, root.rstrip("/"), f"{root.rstrip('/')}-merged"

    def _manifest(self) -> Row | None:
        # at most two files of one row each
        try:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.merged}/manifest*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return max(rows, key=lambda r: r.version, default=None)

    def through(self, state: int) -> int:
        """The last run of the state whose points are merged, -1 if none is."""
        manifest = self._manifest()
        return manifest.through if manifest is not None and manifest.state == state else -1

    def merge(self, state: int, last: int) -> None:
        """Merge the runs of the state up to ``last``; those of earlier states are no longer merged ones."""
        manifest = self._manifest()
        same = manifest is not None and manifest.state == state
        begin = manifest.through + 1 if same else 0
        fresh = self._runs(state, begin, last)
        if fresh is None:
            return
        part = uuid.uuid4().hex
        days = dict(manifest.days) if same else {}
        touched = [str(r.day) for r in fresh.select(_day()).distinct().collect()]
        before = [days[d] for d in touched if d in days]
        rows = fresh.select(*_COLUMNS, "run")
        if before:
            rows = rows.union(self._read(before).select(*_COLUMNS, "run"))
        target = f"{self.merged}/part={part}"
        ordered = rows.withColumn("day", _day()).hint("rebalance", "day", "measurement").sortWithinPartitions("day", "measurement", "epoch")
        ordered.write.partitionBy("day", "measurement").parquet(target)
        days.update((d, f"{target}/day={d}") for d in touched)
        replaced = [*before, *(f"{self.root}/state={state}/run={i}" for i in range(begin, last + 1))]
        version = 0 if manifest is None else manifest.version + 1
        row = Row(version=version, state=state, through=last, days=days, replaced=replaced)
        self.spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.merged}/manifest{version % 2}")
        if manifest is not None:
            self._delete(manifest.replaced)

    def read(self, state: int, since: int | None = None, until: int | None = None) -> DataFrame:
        """All points of the state, or those whose ``epoch`` is from ``since`` on and before ``until``.

        Only folders of their days are opened, and of the runs that are not merged yet.
        """
        manifest = self._manifest()
        same = manifest is not None and manifest.state == state
        wanted = (lambda d: (since is None or d >= since // DAY) and (until is None or d <= (until - 1) // DAY))
        paths = [p for d, p in manifest.days.items() if wanted(int(d))] if same else []
        parts = [self._read(paths).select(*_COLUMNS, "run")] if paths else []
        fresh = self._runs(state, manifest.through + 1 if same else 0)
        if fresh is not None:
            parts.append(fresh.select(*_COLUMNS, "run"))
        out = parts[0] if parts else self.spark.createDataFrame([], f"{POINT_SCHEMA}, run bigint")
        for more in parts[1:]:
            out = out.union(more)
        out = out if since is None else out.where(F.col("epoch") >= since)
        return out if until is None else out.where(F.col("epoch") < until)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(f"{POINT_SCHEMA}, run bigint, part string, day bigint").option("basePath", self.merged).parquet(*paths)

    def _runs(self, state: int, first: int, last: int | None = None) -> DataFrame | None:
        """Points of runs that are still folders of their own, none if there are no such runs."""
        folder = f"{self.root}/state={state}"
        names = [n for n in self._list(folder) if n.startswith("run=")]
        found = [i for i in sorted(int(n.removeprefix("run=")) for n in names) if i >= first and (last is None or i <= last)]
        if not found:
            return None
        reader = self.spark.read.schema(f"{POINT_SCHEMA}, state bigint, run bigint").option("basePath", self.root)
        return reader.parquet(*[f"{folder}/run={i}" for i in found]).drop("state")

    def _files(self, path: str):
        paths = self.spark._jvm.org.apache.hadoop.fs
        return paths.Path(path).getFileSystem(self.spark._jsc.hadoopConfiguration()), paths.Path

    def _list(self, folder: str) -> list[str]:
        files, path = self._files(folder)
        return [s.getPath().getName() for s in files.listStatus(path(folder))] if files.exists(path(folder)) else []

    def _delete(self, folders: list[str]) -> None:
        for folder in folders:
            files, path = self._files(folder)
            files.delete(path(folder), True)


def _day():
    return F.expr(f"epoch div {DAY}").alias("day")
