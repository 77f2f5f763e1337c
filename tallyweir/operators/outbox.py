"""Points whose delivery failed: whole sends, the newest ones kept, replayed first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def retained(saved: DataFrame, limit: int, send: str = "run") -> DataFrame:
    """Points of the newest ``limit`` sends, each send kept whole."""
    # At most ``limit`` send numbers, so the kept side of the join is bounded by an option.
    newest = saved.select(send).distinct().orderBy(F.desc(send)).limit(limit)
    return saved.join(newest, send, "left_semi")


def replayed(saved: DataFrame, new: DataFrame, limit: int, send: str = "run") -> DataFrame:
    """What goes out next: the retained sends marked ``resent``, and the new points."""
    old = retained(saved, limit, send).withColumn("resent", F.lit(True))
    return old.unionByName(new.withColumn("resent", F.lit(False)))
