"""Inputs for the registered queries, derived by Spark from the given tables.

``access_log`` turns every row of ``events`` into one log line, with valid,
broken, repeated and out-of-order cases spread by the event id; all text comes
from integer and string expressions, so other engines print the same lines.
``order_contacts`` reads orders as requests and their line items as contacts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweir.session import tune

BUCKET_DURATION = 3600
ORDER_BUCKET_DURATION = 86_400
LOG_SOURCE = "access.log"
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the zone-less times of the tables are read as UTC
    tune(spark).conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id``, ``user_id``, ``source`` and the log line as ``value``."""
    return access_log_of(table(spark, sf_dir, "events").select(*EVENT_COLUMNS))


def access_log_of(events: DataFrame) -> DataFrame:
    return events.selectExpr("event_id", "user_id", f"'{LOG_SOURCE}' AS source", f"{log_line()} AS value")


def spread(events: DataFrame, sf_dir: str) -> DataFrame:
    """Events dealt evenly by their id: a row becomes a line of many times its size, so few file splits are much work."""
    n = partitions_for(events.sparkSession, sf_dir, "events", EVENT_BYTES)
    return events.select(*EVENT_COLUMNS).repartition(n, "event_id")


def access_log_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as the logs of three hosts."""
    return by_host(access_log(spark, sf_dir))


def by_host(log: DataFrame) -> DataFrame:
    return log.withColumn("source", F.expr("concat('web', user_id % 3, '/access.log')"))


HOSTS = 12


def host_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the host whose log has their line as ``source``; ``write_logs`` makes the lines."""
    events = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    return events.withColumn("source", F.expr(f"concat('web', user_id % {HOSTS})"))


def write_logs(events: DataFrame, folder: str, name: str = "access.log", end: str = "\n", value: str | None = None) -> None:
    """Write the log of each source into ``folder``/source/``name``, replacing it; ``end`` follows every line.

    Events go to their host's task and are put in order as narrow rows; ``value`` makes lines of them afterwards.
    """
    spark = events.sparkSession
    scratch = f"{folder}-{uuid.uuid4().hex}"
    # a task for each host: by hash some tasks would write the logs of several
    dealt = events.repartitionById(HOSTS, F.expr(f"int(coalesce(pmod(user_id, {HOSTS}), 0))"))
    ordered = dealt.sortWithinPartitions("source", "event_id").selectExpr("source", f"{value or log_line()} AS value")
    ordered.write.partitionBy("source").option("lineSep", end).text(scratch)
    paths = spark._jvm.org.apache.hadoop.fs
    files = paths.Path(scratch).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(paths.Path(f"{scratch}/source=*/part-*")):
        source = found.getPath().getParent().getName().removeprefix("source=")
        files.mkdirs(paths.Path(f"{folder}/{source}"))
        files.delete(paths.Path(f"{folder}/{source}/{name}"), False)
        files.rename(found.getPath(), paths.Path(f"{folder}/{source}/{name}"))


def rename_logs(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Rename the log files of all sources, as a rotation does."""
    paths = spark._jvm.org.apache.hadoop.fs
    files = paths.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(paths.Path(f"{folder}/*/{old}")):
        files.rename(found.getPath(), paths.Path(found.getPath().getParent(), new))


def _padded(number: str) -> str:
    return f"lpad(string({number}), 3, '0')"


def log_line() -> str:
    us = "unix_micros(cast(ts AS TIMESTAMP))"
    a, b = "concat('10.0.0.', user_id % 4, ':80')", "concat('10.0.1.', user_id % 3, ':81')"
    t = f"concat('0.', {_padded('event_id * 13 % 1000')})"

    def by_case(none: str, one: str, two: str, three: str, four: str) -> str:
        return (
            f"CASE event_id % 5 WHEN 0 THEN {none} WHEN 1 THEN {one} WHEN 2 THEN {two} "
            f"WHEN 3 THEN {three} ELSE {four} END"
        )

    fields = [
        "CASE WHEN event_id % 97 = 0 THEN '2' ELSE '1' END",
        f"CASE WHEN event_id % 101 = 0 THEN 'xxx' "
        f"WHEN event_id % 107 = 0 THEN concat({us} div 3600000000 * 3600, '.000') "
        f"ELSE concat({us} div 1000000, '.', {_padded(f'{us} % 1000000 div 1000')}) END",
        "concat('site', user_id % 7, '.example')",
        "CASE WHEN user_id % 2 = 0 THEN 's' ELSE '-' END",
        "CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE '-' END",
        "CASE WHEN event_id % 127 = 0 THEN 'abc' ELSE CASE event_type WHEN 'view' THEN '200' WHEN 'click' THEN '302' "
        "WHEN 'purchase' THEN '201' WHEN 'signup' THEN '404' ELSE '502' END END",
        "CASE WHEN event_id % 131 = 0 THEN '12.5' ELSE string(bigint(round(value * 100))) END",
        "CASE WHEN event_id % 137 = 0 THEN '1.5d' WHEN event_id % 3 = 0 THEN concat('1.', event_id % 10) ELSE '-' END",
        "string(100 + event_id % 900)",
        f"CASE WHEN event_id % 109 = 0 THEN '-' ELSE concat('0.', {_padded('event_id * 7 % 1000')}) END",
        by_case("'-'", a, f"concat({a}, ', ', {b})", f"concat({a}, ' : ', {b})", f"concat({a}, ', ', {a})"),
        by_case("'-'", "'200'", "'502, 200'", "'200 : 200'", "'502, 200'"),
        "CASE WHEN event_id % 103 = 0 THEN 'x0.1' ELSE "
        + by_case("'-'", t, f"concat({t}, ', 0.010')", f"concat({t}, ' : 0.010')", f"concat({t}, ', 0.020')")
        + " END",
        by_case("'-'", "'0.001'", "'0.001, -'", "'0.001 : 0.002'", "'0.001, -'"),
        "CASE WHEN event_id % 4 = 0 THEN '-' ELSE "
        + by_case("'-'", t, "'-, 0.008'", f"concat({t}, ' : 0.009')", "'-, 0.008'")
        + " END",
    ]
    return (
        "CASE WHEN event_id % 113 = 0 THEN '1|1704067432.824|short' "
        f"ELSE concat_ws('|', {', '.join(fields)}) END"
    )


#: Bytes of a table's files for each partition that its rows are dealt to.
PARTITION_BYTES = 8 << 20
EVENT_BYTES = 1 << 20


def partitions_for(spark: SparkSession, sf_dir: str, name: str, share: int | None = None) -> int:
    """Partitions that grow with a table, so that a task's share of it does not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // (share or PARTITION_BYTES)))


def order_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts of requests in relational form: request, bucket, upstream, status, response seconds."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_quantity")
    # dealt by request, which the join and what is counted per request then share
    n = partitions_for(spark, sf_dir, "lineitem")
    items, orders = items.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey AS request",
        f"ceil(unix_seconds(cast(o_orderdate AS TIMESTAMP)) / {ORDER_BUCKET_DURATION}) AS bucket",
        "string(l_suppkey) AS upstream",
        "l_returnflag AS status",
        "l_quantity / 1000 AS response",
    )


LONGEST_LIST = 4000


def supplier_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose upstream lists hold a contact per line item, servers repeated: of orders, of suppliers and of thirds of
    all suppliers.  A list is dealt to as many lines as it has ``LONGEST_LIST`` items, so lines have 1 to about 5,000.
    """
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 10 = 1 THEN concat('o', l_orderkey) WHEN l_orderkey % 2 = 0 THEN concat('s', l_suppkey) "
        "ELSE concat('m', l_suppkey % 3) END AS list",
        "l_orderkey",
        "l_linenumber",
        "concat('10.0.', l_partkey % 7, '.', l_partkey % 1000, ':80') AS server",
        "CASE l_returnflag WHEN 'A' THEN '200' WHEN 'R' THEN '404' ELSE '502' END AS status",
        "concat('0.', lpad(string(int(l_quantity)), 3, '0')) AS response",
    )
    # only long lists are looked up, one row per LONGEST_LIST items at most: a join by list would bring a list to one task
    parts = items.groupBy("list").agg(F.expr(f"ceil(count(*) / {LONGEST_LIST}) AS parts")).where("parts > 1")
    dealt = items.join(F.broadcast(parts), "list", "left").withColumn("part", F.expr("l_orderkey % coalesce(parts, 1)"))
    dealt = dealt.repartition(partitions_for(spark, sf_dir, "lineitem"), "list", "part")
    lists = dealt.groupBy("list", "part").agg(F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", "server", "status", "response"))).alias("c"))
    head = "concat('1|1704067200|', list, '.', part, '|s|-|200|10|-|20|0.5|')"
    fields = ["array_join(c.server, ', ')", "array_join(c.status, ', ')", *["array_join(c.response, ', ')"] * 3]
    return lists.selectExpr("'suppliers' AS source", f"concat({head}, concat_ws('|', {', '.join(fields)})) AS value")


def wide_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per event with numbers beyond 64 bits, beyond 32 bits where a status is meant, and beyond 9e12."""
    fields = [
        "'1'", "string(unix_seconds(CAST(ts AS TIMESTAMP)))", "'wide'", "'s'", "'-'", "concat('9000000000', event_id % 2)",
        "'123456789012345678901234567890'", "'-'", "'98765432109876543210'", "concat('1000000000000', event_id % 7, '.5')", "'A, B, A'",
        "concat('123456789012345678901234', event_id % 3, ', +0200, 000')", "'1e13, -, 2.5e20'", "'.5, -, 20000000000000'", "'-, -, -'",
    ]
    return table(spark, sf_dir, "events").selectExpr("'wide' AS source", f"concat_ws('|', {', '.join(fields)}) AS value")
