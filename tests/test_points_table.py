"""Points of many runs merged by day: what is read stays the same, from fewer files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from test_runs import Store, at, hits, point_set

from tallyweir import METRICS, MetricsRuns, RunOptions
from tallyweir.sources.points_table import DAY, PointsTable


def many_runs(spark, root, first, last):
    """Runs that publish all metrics of one hour each, written at once as their own folders."""
    columns = {
        "source": "'s'", "bucket": "hour", "epoch": "hour * 3600", "time": "string(hour)", "vhost": "'v'", "protocol": "'https'", "loctag": "'-'",
        "upstream": "string(NULL)", "status": "string(NULL)", "value_i": "hour", "value_d": "double(NULL)",
    }
    names = ", ".join(f"'{m}'" for m in METRICS)
    rows = spark.range(first, last).selectExpr("id AS run", "0L AS state", "id + 1 AS hour", f"explode(array({names})) AS measurement")
    rows = rows.selectExpr(*[f"{c} AS {n}" for n, c in columns.items()], "measurement", "state", "run").repartition(1)
    rows.write.mode("append").partitionBy("state", "run", "measurement").parquet(root)


def test_two_hundred_runs_and_one_hour_of_them(spark, tmp_path):
    root = f"{tmp_path}/points"
    table = PointsTable(spark, root)
    assert table.read(0).collect() == []
    for first, last in ((0, 150), (150, 200)):
        many_runs(spark, root, first, last)
        before = point_set(table.read(0))
        table.merge(0, last - 1)
        assert point_set(table.read(0)) == before and len(before) == last * len(METRICS)
    hour = table.read(0, 170 * 3600, 171 * 3600)
    assert len(hour.inputFiles()) <= len(METRICS) == 17
    assert sorted(r.measurement for r in hour.collect()) == sorted(METRICS) and {r.run for r in hour.collect()} == {169}
    # what the first merge replaced is gone, fresh runs come beside the merged ones
    assert not os.path.exists(f"{root}/state=0/run=10") and table.through(0) == 199
    many_runs(spark, root, 200, 201)
    assert table.read(0).agg(F.countDistinct("run")).first()[0] == 201
    assert table.read(0, 0, DAY).agg(F.max("epoch")).first()[0] < DAY
    assert table.read(1).collect() == [] and table.through(1) == -1


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/points"
    many_runs(spark, root, 0, 3)
    table = PointsTable(spark, root)
    table.merge(0, 1)
    before = point_set(table.read(0))
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **b: 1 / 0)
    try:
        table.merge(0, 2)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert point_set(table.read(0)) == before and table.through(0) == 1
    table.merge(0, 2)
    assert point_set(table.read(0)) == before and table.through(0) == 2


def test_runs_keep_what_is_owed(spark, lines_of, tmp_path):
    store = Store()
    runs = MetricsRuns(spark, f"{tmp_path}/state", RunOptions(skip_to_end=False, lookback_factor=0), store)
    runs.run(lines_of(*at(1)))
    store.broken = True
    runs.run(lines_of(*at(2)))
    runs.merge_points()
    assert runs.published.through(0) == 0
    store.broken = False
    runs.run(lines_of(*at(3)))
    runs.merge_points()
    assert runs.published.through(0) == 2
    assert hits(runs) == [(1, 1), (2, 1), (3, 1)] and hits(runs, 1) == [(2, 1)]
    assert len(store.sends) == 3 and {r.bucket for r in runs.points_between(120, 180).collect()} == {2}
