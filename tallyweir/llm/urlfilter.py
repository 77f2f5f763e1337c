"""URL filters by a temporal join: which entries of dated lists were active when a page was fetched.

A list is a log of dated changes: from a day on a pattern is on it, or off it.  Changes become intervals of
validity, and every capture is held against the entries that were valid at its time.  A pattern is a
host, a domain with all hosts below it, or the beginning of a path on a host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyweir.llm.shared import passed

HOST, DOMAIN, PATH = "host", "domain", "path"
ALLOW, BLOCK, NONE = "allow", "block", "none"

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)?"


def host_of(url: str) -> str:
    """Lower-cased host of a URL without user, port and final dot; empty if there is none."""
    return f"trim(TRAILING '.' FROM lower(regexp_extract({url}, r'{_HOST}', 1)))"


def path_of(url: str) -> str:
    """Path of a URL, ``/`` if it has none."""
    return f"coalesce(nullif(regexp_extract({url}, r'{_PATH}', 1), ''), '/')"


def intervals(changes: DataFrame) -> DataFrame:
    """``list``, ``verdict``, ``kind``, ``pattern``, ``since``, ``until`` (exclusive, null: still valid).

    ``changes`` has ``list``, ``verdict`` (``allow`` or ``block``), ``kind``, ``pattern``, ``day`` (date) and
    ``listed`` (boolean).  Of changes of one entry on one day, being listed wins.  Changes with a null in any
    of these are left out, and repeated ones count once.
    """
    entry = ["list", "verdict", "kind", "pattern"]
    daily = changes.select(*entry, "day", "listed").dropna().groupBy(*entry, "day").agg(F.max("listed").alias("listed"))
    order = Window.partitionBy(*entry).orderBy("day")
    return (
        daily.withColumn("until", F.lead("day").over(order))
        .where("listed")
        .selectExpr(*entry, "day AS since", "until")
    )


def judged(captures: DataFrame, valid: DataFrame) -> DataFrame:
    """``captures`` (``url``, ``fetched``) with ``verdict``, ``list``, ``kind`` and ``pattern`` of the deciding entry.

    An allowing entry outweighs blocking ones; among those of one verdict a host outweighs a path and a path
    a domain, longer patterns shorter ones, then the list's name decides.  Without an active entry, without a
    host in the URL, or with a null ``url`` or ``fetched``, the verdict is ``none`` and the rest null.  All
    rows and columns stay; columns named like the results, in any case of letters, are replaced.
    No captures or no entries are no error;
    URLs of any length are read whole.

    Captures are made distinct before the join, so that a host with very many of them meets its entries once
    per URL and day; the joins are plain equi-joins, which Spark splits where a key is frequent.
    """
    distinct = captures.select("url", "fetched").where("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    parts = distinct.selectExpr("url", "fetched", f"{host_of('url')} AS host", f"{path_of('url')} AS path").where("host <> ''")
    labels = "split(host, r'\\.')"
    above = f"transform(sequence(1, size({labels})), i -> array_join(slice({labels}, i, size({labels})), '.'))"
    # "/a/b" begins with "/", "/a", "/a/" and "/a/b", as far as patterns end at a slash or the whole path; a path is
    # followed as deep as any pattern goes, so a very long one costs no more than others
    deepest = valid.where(F.col("kind") == PATH).agg(F.max(F.expr("size(split(pattern, '/'))"))).first()[0] or 0
    folders = f"split(path, '/', {deepest + 2})"
    below = (
        f"array_distinct(concat(transform(slice(sequence(1, size({folders})), 1, least(size({folders}) - 1, {deepest})), "
        f"i -> host || array_join(slice({folders}, 1, i), '/') || '/'), array(host || path)))"
    )
    keys = parts.selectExpr(
        "url",
        "fetched",
        f"inline(concat(array(struct('{HOST}' AS kind, host AS pattern)), transform({above}, p -> struct('{DOMAIN}' AS kind, p AS pattern)),"
        f" transform({below}, p -> struct('{PATH}' AS kind, p AS pattern))))",
    )
    active = keys.join(valid, ["kind", "pattern"]).where("since <= fetched AND (until IS NULL OR fetched < until)")
    rank = f"struct(verdict = '{ALLOW}' AS a, CASE kind WHEN '{HOST}' THEN 3 WHEN '{PATH}' THEN 2 ELSE 1 END AS b, char_length(pattern) AS c)"
    deciding = active.groupBy("url", "fetched").agg(
        F.min(F.expr(f"struct(-int({rank}.a) AS a, -{rank}.b AS b, -{rank}.c AS c, list, pattern, kind, verdict)")).alias("entry")
    ).selectExpr("url AS at_url", "fetched AS at", "entry")
    passing = captures.select(passed(captures, ("verdict", "list", "kind", "pattern")), F.col("url").alias("own_url"), F.col("fetched").alias("own"))
    joined = passing.join(deciding, (F.col("own_url") == F.col("at_url")) & (F.col("own") == F.col("at")), "left")
    return joined.select("row.*", F.coalesce("entry.verdict", F.lit(NONE)).alias("verdict"), "entry.list", "entry.kind", "entry.pattern")


def _number(text: str) -> str:
    return f"bigint(conv(substr(md5({text}), 1, 7), 16, 10))"


def derived_captures(pages: DataFrame) -> DataFrame:
    """The pages with a day on which each was fetched, which the table lacks: one of 366, by the page's id."""
    return pages.select("page_id", "url", F.expr("date_add(DATE '2024-01-01', int(coalesce(pmod(page_id * 7, 366), 0)))").alias("fetched"))


def derived_changes(pages: DataFrame) -> DataFrame:
    """Dated lists over the hosts of the pages, which no table holds, chosen by checksums of their names.

    A third of the hosts goes on a block list and, half of these, off it again and later on; some of their
    domains are blocked from a day on, some hosts are allowed, and some first folders are blocked.
    """
    hosts = pages.where("url IS NOT NULL").selectExpr(f"{host_of('url')} AS host", f"{path_of('url')} AS path").where("host <> ''")
    seen = hosts.select("host").distinct().selectExpr("host", f"{_number('host')} AS n")
    domains = hosts.selectExpr("substring_index(host, '.', -3) AS domain").distinct().selectExpr("domain", f"{_number('domain')} AS n")
    folders = hosts.where("path RLIKE '^/[^/]+/.'").selectExpr("host || '/' || split(path, '/')[1] || '/' AS folder").distinct().selectExpr("folder", f"{_number('folder')} AS n")

    def day(plus: str) -> str:
        return f"date_add(DATE '2023-12-01', int(n % 300 + {plus})) AS day"

    def entries(frame: DataFrame, name: str, verdict: str, kind: str, pattern: str, which: str, plus: str, listed: str) -> DataFrame:
        return frame.where(which).selectExpr(f"'{name}' AS list", f"'{verdict}' AS verdict", f"'{kind}' AS kind", f"{pattern} AS pattern", day(plus), f"{listed} AS listed")

    parts = [
        entries(seen, "hosts", BLOCK, HOST, "host", "n % 3 = 0", "0", "true"),
        entries(seen, "hosts", BLOCK, HOST, "host", "n % 6 = 0", "60", "false"),
        entries(seen, "hosts", BLOCK, HOST, "host", "n % 12 = 0", "120", "true"),
        entries(domains, "domains", BLOCK, DOMAIN, "domain", "n % 5 = 0", "30", "true"),
        entries(seen, "trusted", ALLOW, HOST, "host", "n % 7 = 0", "90", "true"),
        entries(folders, "folders", BLOCK, PATH, "folder", "n % 4 = 0", "45", "true"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
