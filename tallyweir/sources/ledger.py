"""Bodies that are sent once: what was sent is written down, and a repeated delivery leaves it out.

Lines are brought into one order, so a repeated delivery cuts them into the same bodies under the same numbers.  Bodies
go out in waves; the numbers of a wave are written when all of it is sent.  Only a wave that dies half-way is sent again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweir.sources.sinks import DEFAULT_BATCH_SIZE, batch_bodies

LEDGER_SCHEMA = "number bigint, points bigint"
#: Bodies that are sent before their numbers are written.
WAVE = 1000


class SendOnce:
    """A sink of runs that renders points by ``lines_of`` and calls ``send(body)`` on the executors, once for each body.

    ``epoch`` tells the runs of one state folder from those after it was started over.  ``sent`` counts the points of
    this object's calls.
    """

    def __init__(
        self, spark: SparkSession, folder: str, send: Callable[[str], None], lines_of: Callable[[DataFrame], DataFrame], epoch: int = 0,
        batch_size: int = DEFAULT_BATCH_SIZE,
    ) -> None:
        self.spark, self.folder, self.send, self.lines_of = spark, folder.rstrip("/"), send, lines_of
        self.epoch, self.batch_size, self.sent = epoch, batch_size, 0

    def ledger(self, run: int) -> DataFrame:
        """The bodies of a run that are known to be sent."""
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self._path(run))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def _path(self, run: int) -> str:
        return f"{self.folder}/epoch={self.epoch}/run={run}"

    def __call__(self, points: DataFrame) -> None:
        for row in sorted(points.select("run").distinct().collect()):
            self._deliver(row.run, points.where(F.col("run") == row.run))

    def _deliver(self, run: int, points: DataFrame) -> None:
        bodies = batch_bodies(self.lines_of(points).orderBy("line"), self.batch_size)
        owed = bodies.join(self.ledger(run).select("number"), "number", "left_anti")
        last = owed.agg(F.max("number")).first()[0]
        send = self.send

        def sending(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for body in batch["body"]:
                    send(body)
                yield batch[["number", "points"]]

        for first in range(0, -1 if last is None else last + 1, WAVE):
            wave = owed.where(f"number >= {first} AND number < {first + WAVE}")
            before = self.ledger(run).agg(F.sum("points")).first()[0] or 0
            wave.mapInPandas(sending, LEDGER_SCHEMA).write.mode("append").parquet(self._path(run))
            self.sent += self.ledger(run).agg(F.sum("points")).first()[0] - before
