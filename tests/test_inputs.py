"""Inputs of the registered queries whose tasks must not grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweir.operators.flat_contacts import flat_contact_statuses
from tallyweir.plans import catalog, inputs

SF = "/root/testdata/sf0.001"


def test_contacts_of_orders_are_dealt_to_partitions_that_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(inputs, "PARTITION_BYTES", 5000)
    contacts = inputs.order_contacts(spark, SF)
    assert contacts.rdd.getNumPartitions() == inputs.partitions_for(spark, SF, "lineitem") > 20


def test_statuses_per_request_stay_where_the_join_dealt_them(spark):
    plan = flat_contact_statuses(inputs.order_contacts(spark, SF))._jdf.queryExecution().executedPlan().toString()
    # both tables, and the sums of buckets and servers
    assert plan.count("Exchange hashpartitioning") == 3


def test_events_are_spread_over_more_tasks_than_their_file_has_splits(spark, monkeypatch):
    monkeypatch.setattr(inputs, "EVENT_BYTES", 1000)
    events = inputs.table(spark, SF, "events")
    parts = inputs.spread(events, SF).rdd.glom().map(len).collect()
    assert len(parts) > 20 and max(parts) < 3 * events.count() / len(parts)


def test_long_lists_are_not_joined_by_list(spark, monkeypatch):
    whole = sorted(r.value for r in inputs.supplier_log(spark, SF).collect())
    monkeypatch.setattr(inputs, "PARTITION_BYTES", 5000)
    # no size is small enough to be broadcast by itself
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = inputs.supplier_log(spark, SF)
        assert "SortMergeJoin" not in log._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r.value for r in log.collect()) == whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_of_a_capped_run_come_from_many_files(spark, monkeypatch):
    monkeypatch.setattr(inputs, "EVENT_BYTES", 1000)
    seen = []
    monkeypatch.setattr(catalog.MetricsRuns, "run", lambda self, lines: seen.append(lines))
    catalog.capped_runs(spark, SF)
    # the first block of events lies in one split of their table; all runs read the same lines
    files = {f.select(F.input_file_name()).where("block = 0").distinct().count() for f in seen}
    assert len(seen) == 4 and min(files) > 20


def test_events_of_a_stream_are_spread_over_more_tasks_than_their_file_has_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "EVENT_BYTES", 1000)
    parts = []

    def note(batch, _):
        parts.extend(r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect())

    stream = catalog._event_stream(spark, SF).writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "stream"))
    stream.trigger(availableNow=True).start().awaitTermination()
    assert len(parts) > 20 and max(parts) < 3 * sum(parts) / len(parts)


def test_each_host_log_is_written_by_a_task_of_its_own_in_order(spark, tmp_path):
    events = inputs.host_events(spark, SF)
    tasks = []
    real = type(events).repartitionById

    def seen(frame, n, by):
        dealt = real(frame, n, by)
        tasks.extend(r.hosts for r in dealt.groupBy(F.spark_partition_id()).agg(F.count_distinct("source").alias("hosts")).collect())
        return dealt

    type(events).repartitionById = seen
    try:
        inputs.write_logs(events, str(tmp_path / "hosts"), value="event_id || ' ' || user_id")
    finally:
        type(events).repartitionById = real
    assert tasks == [1] * inputs.HOSTS
    for host in range(inputs.HOSTS):
        rows = events.where(f"user_id % {inputs.HOSTS} = {host}").orderBy("event_id").collect()
        assert (tmp_path / "hosts" / f"web{host}" / "access.log").read_text().splitlines() == [f"{r.event_id} {r.user_id}" for r in rows]
