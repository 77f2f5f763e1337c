"""Upstream metrics of contacts that come as rows, one per contact, instead of lists.

The rows of one request may lie anywhere and be many, so nothing is collected:
they are added up per request, server and status (partial sums before the
shuffle), and only those sums are weighted by how often the request met the server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyweir.functions.numbers import mean_from_micros, micros

_REQUEST = ("request", "bucket", "upstream")


def flat_contact_means(contacts: DataFrame) -> DataFrame:
    """Hits and weighted mean response time per bucket and server.

    Takes rows of ``request``, ``bucket``, ``upstream`` and ``response`` in seconds.
    """
    per_request = contacts.groupBy(*_REQUEST).agg(
        F.expr("count(*) AS n"), F.expr(f"sum(CAST({micros('response')} AS DECIMAL(38, 0))) AS us"), F.expr("count(response) AS c")
    )
    sums = per_request.groupBy("bucket", "upstream").agg(
        F.expr("sum(n) AS hits"), F.expr("sum(n * us) AS us"), F.expr("sum(n * c) AS c")
    )
    return sums.selectExpr("bucket", "upstream", "hits", f"{mean_from_micros('us', 'c')} AS response_time_mean")


def flat_contact_statuses(contacts: DataFrame) -> DataFrame:
    """Hits per bucket, server and status: each distinct status of a request counts all its contacts of the server."""
    # Rows that come dealt by request stay where they are: the counts and the window over them need no exchange then.
    per_status = contacts.groupBy(*_REQUEST, "status").agg(F.expr("count(*) AS k"))
    # One row per distinct status is left of a request and server, so the window is small.
    weighted = per_status.withColumn("n", F.sum("k").over(Window.partitionBy(*_REQUEST)))
    return weighted.groupBy("bucket", "upstream", "status").agg(F.expr("sum(n) AS hits"))
