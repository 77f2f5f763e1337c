"""The registered queries in SQL over the same tables, written from the definitions.

Each statement is a chain of common table expressions ending in one ``SELECT``.
"""

from __future__ import annotations

# Accepted number texts.
_INT = r"\s*[+-]?\d+\s*"
_DEC = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"

_DURATION = 3600
_ORDER_DURATION = 86400

_LOG = r"""
us AS (
  SELECT event_id, user_id, event_type, value AS amount, epoch_us(ts) AS us, event_id % 5 AS c,
         '10.0.0.' || (user_id % 4) || ':80' AS a, '10.0.1.' || (user_id % 3) || ':81' AS b,
         '0.' || lpad(CAST(event_id * 13 % 1000 AS VARCHAR), 3, '0') AS t
  FROM events
),
log AS (
  SELECT event_id, user_id, {source} AS source,
    CASE WHEN event_id % 113 = 0 THEN '1|1704067432.824|short' ELSE
      concat_ws('|',
        CASE WHEN event_id % 97 = 0 THEN '2' ELSE '1' END,
        CASE WHEN event_id % 101 = 0 THEN 'xxx'
             WHEN event_id % 107 = 0 THEN (us // 3600000000 * 3600) || '.000'
             ELSE (us // 1000000) || '.' || lpad(CAST(us % 1000000 // 1000 AS VARCHAR), 3, '0') END,
        'site' || (user_id % 7) || '.example',
        CASE WHEN user_id % 2 = 0 THEN 's' ELSE '-' END,
        CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE '-' END,
        CASE WHEN event_id % 127 = 0 THEN 'abc' WHEN event_type = 'view' THEN '200'
             WHEN event_type = 'click' THEN '302' WHEN event_type = 'purchase' THEN '201'
             WHEN event_type = 'signup' THEN '404' ELSE '502' END,
        CASE WHEN event_id % 131 = 0 THEN '12.5' ELSE CAST(CAST(round(amount * 100) AS BIGINT) AS VARCHAR) END,
        CASE WHEN event_id % 137 = 0 THEN '1.5d' WHEN event_id % 3 = 0 THEN '1.' || (event_id % 10) ELSE '-' END,
        CAST(100 + event_id % 900 AS VARCHAR),
        CASE WHEN event_id % 109 = 0 THEN '-' ELSE '0.' || lpad(CAST(event_id * 7 % 1000 AS VARCHAR), 3, '0') END,
        CASE c WHEN 0 THEN '-' WHEN 1 THEN a WHEN 2 THEN a || ', ' || b WHEN 3 THEN a || ' : ' || b
               ELSE a || ', ' || a END,
        CASE c WHEN 0 THEN '-' WHEN 1 THEN '200' WHEN 3 THEN '200 : 200' ELSE '502, 200' END,
        CASE WHEN event_id % 103 = 0 THEN 'x0.1' ELSE
          CASE c WHEN 0 THEN '-' WHEN 1 THEN t WHEN 2 THEN t || ', 0.010' WHEN 3 THEN t || ' : 0.010'
                 ELSE t || ', 0.020' END END,
        CASE c WHEN 0 THEN '-' WHEN 1 THEN '0.001' WHEN 3 THEN '0.001 : 0.002' ELSE '0.001, -' END,
        CASE WHEN event_id % 4 = 0 THEN '-' ELSE
          CASE c WHEN 0 THEN '-' WHEN 1 THEN t WHEN 3 THEN t || ' : 0.009' ELSE '-, 0.008' END END)
    END AS value
  FROM us
)"""


def _dec(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '{_DEC}') THEN TRY_CAST({text} AS DOUBLE) END"


def _int(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '{_INT}') THEN TRY_CAST(trim({text}) AS BIGINT) END"


def _flat(field: int) -> str:
    return f"flatten(list_transform(string_split(f[{field}], ', '), lambda x: string_split(x, ' : ')))"


def _bad(entries: str, pattern: str, free: str) -> str:
    return (
        f"len(list_filter({entries}[1:n], lambda x: NOT regexp_full_match(x, '{pattern}') AND x NOT IN ({free}))) > 0"
    )


def _parsed(late_before: str) -> str:
    return rf"""
fields AS (SELECT *, string_split(value, '|') AS f FROM log),
typed AS (
  SELECT event_id, user_id, source, value, f, len(f) AS width, f[1] AS version,
    {_dec("f[2]")} AS msec, f[3] AS vhost, f[4] AS proto, f[5] AS loctag,
    {_int("f[6]")} AS status, {_int("f[7]")} AS bytes_sent, {_dec("f[8]")} AS gzip_ratio,
    {_int("f[9]")} AS request_length, {_dec("f[10]")} AS request_time,
    {_flat(11)} AS la, {_flat(12)} AS ls, {_flat(13)} AS lr, {_flat(14)} AS lc, {_flat(15)} AS lh
  FROM fields
),
sized AS (SELECT *, least(len(la), len(ls), len(lr), len(lc), len(lh)) AS n FROM typed),
parsed AS (
  SELECT *,
    CASE WHEN version <> '1' THEN 'bad_version'
         WHEN width > 1 AND msec IS NULL THEN 'bad_msec'
         WHEN msec <= {late_before} THEN 'late'
         WHEN width < 15 THEN 'short_line'
         WHEN status IS NULL THEN 'bad_status'
         WHEN bytes_sent IS NULL THEN 'bad_bytes_sent'
         WHEN request_length IS NULL THEN 'bad_request_length'
         WHEN f[8] <> '-' AND gzip_ratio IS NULL THEN 'bad_gzip_ratio'
         WHEN f[10] <> '-' AND request_time IS NULL THEN 'bad_request_time'
         WHEN f[11] <> '-' AND ({_bad("ls", _INT, "'-'")} OR {_bad("lr", _DEC, "'-', ''")}
              OR {_bad("lc", _DEC, "'-', ''")} OR {_bad("lh", _DEC, "'-', ''")}) THEN 'bad_upstream'
    END AS reason
  FROM sized
),
requests AS (
  SELECT event_id, source, msec, CAST(ceil(msec / {_DURATION}) AS BIGINT) AS bucket, vhost,
    CASE WHEN proto = 's' THEN 'https' ELSE 'http' END AS protocol, loctag, CAST(status AS VARCHAR) AS status,
    bytes_sent, gzip_ratio, request_length, request_time, proto AS raw_protocol,
    f[11] <> '-' AS upstreamed,
    CASE WHEN f[11] <> '-' THEN len(string_split(f[11], ', ')) END AS servers_contacted,
    CASE WHEN f[11] <> '-' THEN len(list_filter(string_split(f[11], ', '), lambda x: contains(x, ' : '))) END
      AS internal_redirects,
    CASE WHEN f[11] <> '-' THEN n END AS n, la, ls, lr, lc, lh
  FROM parsed WHERE reason IS NULL
),
positions AS (SELECT *, unnest(range(1, n + 1)) AS i FROM requests WHERE upstreamed),
contacts AS (
  SELECT event_id, source, bucket, vhost, protocol, loctag, CAST(i AS INTEGER) AS position, la[i] AS server,
    CASE WHEN ls[i] = '-' THEN '-' ELSE CAST(CAST(trim(ls[i]) AS BIGINT) AS VARCHAR) END AS status,
    TRY_CAST(lr[i] AS DOUBLE) AS response, TRY_CAST(lc[i] AS DOUBLE) AS connect, TRY_CAST(lh[i] AS DOUBLE) AS header
  FROM positions
),
request_servers AS (
  SELECT event_id, source, bucket, vhost, protocol, loctag, server, count(*) AS n,
    {_us_sums("response")}, {_us_sums("connect")}, {_us_sums("header")}
  FROM contacts GROUP BY ALL
),
request_statuses AS (
  SELECT DISTINCT c.event_id, c.source, c.bucket, c.vhost, c.protocol, c.loctag, c.server, c.status, r.n
  FROM contacts c JOIN request_servers r ON c.event_id = r.event_id AND c.server = r.server
)"""


def _us(value: str) -> str:
    return f"CAST(floor({value} * 1000000 + 0.5) AS BIGINT)"


def _us_sums(kind: str) -> str:
    return f"CAST(sum({_us(kind)}) AS BIGINT) AS {kind}_us, count({kind}) AS {kind}_n"


def time_text(bucket: str, duration: int = _DURATION) -> str:
    return f"strftime(make_timestamp({bucket} * {duration} * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')"


ONE_SOURCE = "'access.log'"
BY_HOST = "'web' || (user_id % 3) || '/access.log'"


def with_log(select: str, more: str = "", source: str = ONE_SOURCE, late_before: str = "0") -> str:
    """``select`` over log, parsed, requests, contacts and the sums per request and server."""
    ctes = _LOG.replace("{source}", source) + "," + _parsed(late_before) + (f",\n{more.strip()}" if more else "")
    return f"WITH {ctes.strip()}\n{select.strip()}"


_BASE = "source, bucket, vhost, protocol, loctag"


def _base(value: str, having: str = "") -> str:
    tail = f" HAVING {having}" if having else ""
    return f"SELECT {_BASE}, NULL AS upstream, NULL AS status, {value} AS value FROM requests GROUP BY {_BASE}{tail}"


def _server(value: str, having: str = "") -> str:
    tail = f" HAVING {having}" if having else ""
    return (
        f"SELECT {_BASE}, server AS upstream, NULL AS status, {value} AS value FROM request_servers "
        f"GROUP BY {_BASE}, server{tail}"
    )


def _weighted_mean(kind: str) -> str:
    top, bottom = f"sum(n * {kind}_us)", f"sum(n * {kind}_n)"
    return _server(f"CAST({top} AS DOUBLE) / CAST({bottom} * 1000000 AS DOUBLE)", f"{bottom} > 0")


def _micro_mean(column: str) -> str:
    return f"CAST(sum({_us(column)}) AS DOUBLE) / CAST(count({column}) * 1000000 AS DOUBLE)"


def _per_hit(column: str) -> str:
    return _base(
        f"CAST(sum({column}) AS DOUBLE) / CAST(count(*) FILTER (upstreamed) AS DOUBLE)",
        "count(*) FILTER (upstreamed) > 0",
    )


METRIC_SQL: dict[str, str] = {
    "hits": _base("count(*)"),
    "hits_with_upstream": _base("count(*) FILTER (upstreamed)", "count(*) FILTER (upstreamed) > 0"),
    "status": f"SELECT {_BASE}, NULL AS upstream, status, count(*) AS value FROM requests GROUP BY {_BASE}, status",
    "bytes_sent": _base("CAST(sum(bytes_sent) AS BIGINT)"),
    # zero rows only where the source has a compressed response at all
    "gzip_count": (
        f"SELECT {_BASE}, NULL AS upstream, NULL AS status, count(gzip_ratio) AS value FROM requests "
        "WHERE source IN (SELECT source FROM requests WHERE gzip_ratio IS NOT NULL) "
        f"GROUP BY {_BASE}"
    ),
    "gzip_count_percent": _base("CAST(count(gzip_ratio) AS DOUBLE) / CAST(count(*) AS DOUBLE)"),
    "gzip_ratio_mean": _base(_micro_mean("gzip_ratio"), "count(gzip_ratio) > 0"),
    "request_length_mean": _base("CAST(trunc(CAST(sum(request_length) AS DOUBLE) / count(*)) AS BIGINT)"),
    "request_time_mean": _base(_micro_mean("request_time"), "count(request_time) > 0"),
    "upstreams_hits": _server("CAST(sum(n) AS BIGINT)"),
    "upstreams_status": (
        f"SELECT {_BASE}, server AS upstream, status, CAST(sum(n) AS BIGINT) AS value FROM request_statuses "
        f"GROUP BY {_BASE}, server, status"
    ),
    "upstreams_servers_contacted_per_hit": _per_hit("servers_contacted"),
    "upstreams_internal_redirects_per_hit": _per_hit("internal_redirects"),
    "upstreams_servers": _base("CAST(sum(n) AS BIGINT)", "count(*) FILTER (upstreamed) > 0"),
    "upstreams_response_time_mean": _weighted_mean("response"),
    "upstreams_connect_time_mean": _weighted_mean("connect"),
    "upstreams_header_time_mean": _weighted_mean("header"),
}

_WHOLE = (
    "hits",
    "hits_with_upstream",
    "status",
    "bytes_sent",
    "gzip_count",
    "request_length_mean",
    "upstreams_hits",
    "upstreams_status",
    "upstreams_servers",
)


def _tags_of(name: str) -> str:
    tags = "vhost, protocol, loctag"
    if name.startswith("upstreams_") and name in ("upstreams_hits", "upstreams_status") or "_time_mean" in name:
        tags += ", upstream" if name.startswith("upstreams_") else ""
    return tags + (", status" if name.endswith("status") else "")


def metric_sql(name: str) -> str:
    return with_log(
        f"SELECT {time_text('bucket')} AS time, {_tags_of(name)}, value FROM ({METRIC_SQL[name]})"
    )


def _points(where: str = "TRUE") -> str:
    parts = [
        f"SELECT source, '{name}' AS measurement, bucket, vhost, protocol, loctag, "
        f"CAST(upstream AS VARCHAR) AS upstream, CAST(status AS VARCHAR) AS status, "
        f"{'value' if name in _WHOLE else 'NULL'} AS value_i, {'NULL' if name in _WHOLE else 'value'} AS value_d "
        f"FROM ({sql})"
        for name, sql in METRIC_SQL.items()
    ]
    return "points AS (SELECT * FROM (" + " UNION ALL ".join(parts) + f") WHERE {where})"


def points_sql(select: str, source: str = ONE_SOURCE, where: str = "TRUE", more: str = "") -> str:
    return with_log(select, _points(where) + (f", {more}" if more else ""), source)


# closed buckets lie this many buckets behind the last one of their source
_LOOKBACK = 2
_CLOSED = f"bucket <= (SELECT max(r.bucket) - {_LOOKBACK} FROM requests r WHERE r.source = requests.source)"


def _escaped(text: str) -> str:
    for special in ("\\", " ", ",", "="):
        text = f"replace({text}, '{special}', '\\{special}')"
    return text


def _line_text(static: dict[str, str]) -> str:
    tags = {"vhost": "vhost", "protocol": "protocol", "loctag": "loctag", "upstream": "upstream", "status": "status"}
    parts = [
        f"coalesce(',{name}=' || {_escaped(f'nullif({column}, {chr(39)}{chr(39)})')}, '')"
        for name, column in sorted({**static, **tags}.items())
    ]
    value = "CASE WHEN value_i IS NOT NULL THEN value_i || 'i' ELSE CAST(value_d AS VARCHAR) END"
    return f"measurement || {' || '.join(parts)} || ' value=' || {value} || ' ' || (bucket * {_DURATION} // 60)"


_STATIC = {"host": "split_part(source, '/', 1)", "name": "source"}

_ORDER_CONTACTS = f"""
contacts AS (
  SELECT l_orderkey AS request, CAST(ceil(epoch(o_orderdate) / {_ORDER_DURATION}) AS BIGINT) AS bucket,
    CAST(l_suppkey AS VARCHAR) AS upstream, l_returnflag AS status, l_quantity / 1000 AS response
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
sums AS (
  SELECT request, bucket, upstream, count(*) AS n, sum({_us("response")}) AS us, count(response) AS c
  FROM contacts GROUP BY ALL
)"""


_SUPPLIER_LISTS = f"""
WITH items AS (
  SELECT *, CASE WHEN l_orderkey % 10 = 1 THEN 'o' || l_orderkey WHEN l_orderkey % 2 = 0 THEN 's' || l_suppkey
    ELSE 'm' || (l_suppkey % 3) END AS list FROM lineitem
),
parts AS (SELECT list, CAST(ceil(count(*) / 4000.0) AS BIGINT) AS parts FROM items GROUP BY list),
contacts AS (
  SELECT list || '.' || (l_orderkey % parts) AS vhost, '10.0.' || (l_partkey % 7) || '.' || (l_partkey % 1000) || ':80' AS upstream,
    CASE l_returnflag WHEN 'A' THEN '200' WHEN 'R' THEN '404' ELSE '502' END AS status,
    {_us("CAST(trunc(l_quantity) AS INTEGER) / 1000")} AS us
  FROM items JOIN parts USING (list)
),
met AS (SELECT vhost, upstream, count(*) AS n, CAST(sum(us) AS BIGINT) AS us FROM contacts GROUP BY vhost, upstream)
SELECT 'upstreams_hits' AS measurement, vhost, upstream, NULL AS status, CAST(n AS DOUBLE) AS value FROM met
UNION ALL
SELECT 'upstreams_status', vhost, upstream, status, CAST(n AS DOUBLE)
FROM (SELECT DISTINCT vhost, upstream, status FROM contacts) JOIN met USING (vhost, upstream)
UNION ALL
SELECT 'upstreams_response_time_mean', vhost, upstream, NULL, CAST(n * us AS DOUBLE) / CAST(n * n * 1000000 AS DOUBLE) FROM met
"""

_WIDE_NUMBERS = f"""
WITH lines AS (SELECT event_id, CAST(ceil(epoch_us(ts) // 1000000 / {_DURATION}) AS BIGINT) AS bucket FROM events),
hours AS (SELECT bucket, {time_text("bucket")} AS time, count(*) AS n, sum(10000000000000.5 + event_id % 7) AS seconds FROM lines GROUP BY bucket)
SELECT 'bytes_sent' AS measurement, time, NULL AS upstream, NULL AS status, CAST(NULL AS BIGINT) AS value_i,
  CAST(round(n * 123456789012345678901234567890.0 / 1e25, 0) AS BIGINT) AS scaled FROM hours
UNION ALL
SELECT 'request_length_mean', time, NULL, NULL, NULL, CAST(round(98765432109876543210.0 / 1e9, 0) AS BIGINT) FROM hours
UNION ALL
SELECT 'request_time_mean', time, NULL, NULL, NULL, CAST(round(CAST(seconds AS DOUBLE) / n / 1e9, 0) AS BIGINT) FROM hours
UNION ALL
SELECT 'status', {time_text("bucket")}, NULL, '9000000000' || (event_id % 2), count(*), NULL FROM lines GROUP BY ALL
UNION ALL
SELECT 'upstreams_status', {time_text("bucket")}, 'A', '123456789012345678901234' || (event_id % 3), 2 * count(*), NULL FROM lines GROUP BY ALL
UNION ALL
SELECT 'upstreams_status', time, 'A', '0', 2 * n, NULL FROM hours
UNION ALL
SELECT 'upstreams_status', time, 'B', '200', n, NULL FROM hours
UNION ALL
SELECT 'upstreams_response_time_mean', time, 'A', NULL, NULL, CAST(round((1e13 + 2.5e20) / 2 / 1e9, 0) AS BIGINT) FROM hours
UNION ALL
SELECT 'upstreams_connect_time_mean', time, 'A', NULL, NULL, CAST(round((0.5 + 2e13) / 2 / 1e9, 0) AS BIGINT) FROM hours
"""

# The engine's own texts of numbers are the shortest ones.
_FIELD_TEXTS = """
WITH numbers AS (
  SELECT event_id, amount / 7 AS plain,
    CAST(CASE WHEN event_id % 2 = 0 THEN '-' ELSE '' END || substr(
      (1 + event_id % 9) || lpad(CAST(event_id * 104729 % 100000000 AS VARCHAR), 8, '0') || lpad(CAST(event_id * 7919 % 100000000 AS VARCHAR), 8, '0'),
      1, 1 + event_id % 17) || 'e' || (event_id * 13 % 585 - 300) AS DOUBLE) AS wide
  FROM (SELECT event_id, value AS amount FROM events)
)
SELECT event_id, CAST(wide AS VARCHAR) AS wide, CAST(plain AS VARCHAR) AS plain FROM numbers
"""

_LARGE_SUMS = f"""
WITH lines AS (
  SELECT CAST(ceil(epoch_us(ts) // 1000000 / {_DURATION}) AS BIGINT) AS bucket,
    CAST(9223372036854775000 - event_id % 1000 AS HUGEINT) AS bytes, 9000000000000 - event_id % 7 AS seconds
  FROM events
),
sums AS (SELECT bucket, sum(bytes) AS bytes, sum(seconds * CAST(1000000 AS HUGEINT)) AS us, count(*) AS n FROM lines GROUP BY bucket)
SELECT 'bytes_sent' AS measurement, {time_text("bucket")} AS time,
  CASE WHEN bytes <= 9223372036854775807 THEN CAST(bytes AS BIGINT) END AS value_i,
  CASE WHEN bytes > 9223372036854775807 THEN CAST(round(CAST(bytes AS DOUBLE) / 1e9, 0) AS BIGINT) END AS billions FROM sums
UNION ALL
SELECT 'request_time_mean', {time_text("bucket")}, NULL, CAST(round(CAST(us AS DOUBLE) / (n * 1000000) / 1e9, 0) AS BIGINT) FROM sums
"""

# The second run's lines twice, once as those of a source that only this run meets.
_LATE = f"""
seen AS (SELECT p.*, e.ts, CAST(ceil(p.msec / {_DURATION}) AS BIGINT) AS b FROM parsed p JOIN events e USING (event_id)),
noted AS (SELECT max(b) AS b FROM seen WHERE ts < TIMESTAMP '2024-01-20 00:30:00'),
second AS (SELECT * FROM seen WHERE ts >= TIMESTAMP '2024-01-16 00:30:00')
"""
_LATE_COUNTS = """
SELECT source, reason, CAST(count(*) AS BIGINT) AS lines FROM (
  SELECT source, CASE WHEN reason IN ('bad_version', 'bad_msec') THEN reason
    WHEN b <= (SELECT b FROM noted) THEN 'late' ELSE reason END AS reason FROM second
  UNION ALL
  SELECT 'met.late' AS source, 'baseline' AS reason FROM second
) WHERE reason IS NOT NULL GROUP BY source, reason
"""


# Lines of two steps by two sources; those of the second step in buckets that the first has closed are late.
_SOURCES = f"""
times(name, until, since) AS (
  VALUES ('fast', TIMESTAMP '2024-01-25 00:30:00', TIMESTAMP '2024-01-24 00:30:00'),
         ('slow', TIMESTAMP '2024-01-10 00:30:00', TIMESTAMP '2024-01-08 00:30:00')
),
arrived AS (
  SELECT p.event_id, p.reason, CAST(ceil(p.msec / {_DURATION}) AS BIGINT) AS b, t.name, step
  FROM parsed p JOIN events e USING (event_id), times t, (VALUES (1), (2)) AS steps(step)
  WHERE CASE step WHEN 1 THEN e.ts < t.until ELSE e.ts >= t.since END
),
closed AS (SELECT name, max(b) - {_LOOKBACK} AS first FROM arrived WHERE step = 1 AND reason IS NULL GROUP BY name),
told AS (
  SELECT a.*, c.first, CASE WHEN reason IN ('bad_version', 'bad_msec') OR step = 1 THEN reason WHEN b <= c.first THEN 'late' ELSE reason END AS what
  FROM arrived a LEFT JOIN closed c USING (name)
),
ended AS (SELECT name, max(b) - {_LOOKBACK} AS last FROM told WHERE what IS NULL GROUP BY name)
"""
_SOURCE_COUNTS = f"""
SELECT name AS source, 'hits' AS what, {time_text("bucket")} AS time, vhost, protocol, loctag, count(*) AS n
FROM told JOIN ended USING (name) JOIN requests USING (event_id) WHERE what IS NULL AND b <= last GROUP BY ALL
UNION ALL
SELECT name, what, NULL, NULL, NULL, NULL, count(*) FROM told WHERE what IS NOT NULL GROUP BY ALL
"""


def oracle_statements() -> dict[str, str]:
    hour = time_text("bucket")
    statements = {name: metric_sql(name) for name in METRIC_SQL}

    statements["parse_accepted"] = with_log(
        "SELECT event_id, msec, bucket, vhost, raw_protocol AS protocol, loctag, CAST(status AS INTEGER) AS status, "
        "bytes_sent, gzip_ratio, request_length, request_time, CAST(servers_contacted AS INTEGER) AS servers_contacted, "
        "CAST(internal_redirects AS INTEGER) AS internal_redirects, CAST(n AS INTEGER) AS upstreams_servers FROM requests"
    )
    statements["parse_rejects"] = with_log(
        "SELECT event_id, value AS line, reason FROM parsed WHERE reason IS NOT NULL"
    )
    statements["reject_reasons"] = with_log(
        "SELECT reason, count(*) AS lines FROM parsed WHERE reason IS NOT NULL GROUP BY reason"
    )
    statements["upstream_contacts"] = with_log(
        "SELECT event_id, position, server, status, response, connect, header FROM contacts"
    )
    statements["upstream_request_summary"] = with_log(
        "SELECT event_id, server, CAST(n AS INTEGER) AS n, coalesce(response_us, 0) AS response_us, "
        "CAST(response_n AS INTEGER) AS response_n, coalesce(connect_us, 0) AS connect_us, "
        "CAST(connect_n AS INTEGER) AS connect_n, coalesce(header_us, 0) AS header_us, "
        "CAST(header_n AS INTEGER) AS header_n, statuses FROM request_servers JOIN ("
        "SELECT event_id, server, string_agg(status || 'x' || k, ' ' ORDER BY status) AS statuses FROM ("
        "SELECT event_id, server, status, count(*) AS k FROM contacts GROUP BY ALL) GROUP BY event_id, server"
        ") USING (event_id, server)"
    )
    statements["bucket_assign"] = with_log(f"SELECT event_id, msec, bucket, {hour} AS time FROM requests")
    statements["late_filter"] = with_log(
        "SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS lines FROM parsed GROUP BY ALL",
        late_before="1705276800.5 - 3600 * 2",
    )
    statements["high_water_mark"] = with_log(
        f"SELECT source, max(msec) AS last_msec, max(bucket) - {_LOOKBACK} AS closed_through "
        "FROM requests GROUP BY source",
        source=BY_HOST,
    )
    statements["first_run_baseline"] = with_log(
        f"SELECT source, count(*) AS lines, CAST(ceil(max(msec) / {_DURATION}) AS BIGINT) AS bucket, "
        f"CAST((ceil(max(msec) / {_DURATION}) + {_LOOKBACK}) * {_DURATION} AS DOUBLE) AS last_msec "
        "FROM typed GROUP BY source",
        source=BY_HOST,
    )
    statements["input_cap"] = with_log(
        "SELECT source, coalesce(reason, 'accepted') AS outcome, count(*) AS lines FROM ("
        "SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_id) AS k FROM parsed) "
        "WHERE k <= 2500 GROUP BY ALL",
        source=BY_HOST,
    )
    wide = {name: name for name in METRIC_SQL if "upstream AS upstream" not in METRIC_SQL[name]}
    base = [n for n in wide if not n.endswith("status") and "request_servers" not in METRIC_SQL[n]]
    joined = " ".join(
        f"LEFT JOIN ({METRIC_SQL[n]}) AS m{i} ON b.source = m{i}.source AND b.bucket = m{i}.bucket AND "
        f"b.vhost = m{i}.vhost AND b.protocol = m{i}.protocol AND b.loctag = m{i}.loctag"
        for i, n in enumerate(base)
    )
    values = ", ".join(f"m{i}.value AS {n}" for i, n in enumerate(base))
    statements["metrics_wide"] = with_log(
        f"SELECT {time_text('b.bucket')} AS time, b.vhost, b.protocol, b.loctag, {values} "
        f"FROM ({METRIC_SQL['hits']}) AS b {joined}"
    )
    columns = "vhost, protocol, loctag, upstream, status, value_i, value_d"
    statements["points_long"] = points_sql(f"SELECT measurement, {hour} AS time, {columns} FROM points")
    statements["points_static_tags"] = points_sql(
        f"SELECT measurement, {hour} AS time, "
        "'host=' || split_part(source, '/', 1) || coalesce(',loctag=' || loctag, '') || ',name=' || source "
        "|| ',protocol=' || protocol || coalesce(',status=' || status, '') || coalesce(',upstream=' || upstream, '') "
        "|| ',vhost=' || vhost AS tags, coalesce(CAST(value_i AS DOUBLE), value_d) AS value FROM points",
        source=BY_HOST,
    )
    statements["line_protocol"] = points_sql(f"SELECT {_line_text(_STATIC)} AS line FROM points", source=BY_HOST)
    statements["batch_bodies"] = points_sql(
        "SELECT k // 500 AS number, count(*) AS points, md5(string_agg(line || chr(10), '' ORDER BY line)) AS checksum FROM ("
        f"SELECT line, row_number() OVER (ORDER BY line) - 1 AS k FROM (SELECT {_line_text(_STATIC)} AS line FROM points)) GROUP BY number",
        source=BY_HOST,
    )
    statements["measurement_readback"] = points_sql(
        "SELECT measurement, count(*) AS points, min(coalesce(CAST(value_i AS DOUBLE), value_d)) AS lowest, "
        "max(coalesce(CAST(value_i AS DOUBLE), value_d)) AS highest FROM points GROUP BY measurement"
    )

    closed_requests = f"SELECT * FROM requests WHERE {_CLOSED}"
    hits = "count(*) AS hits, CAST(sum(bytes_sent) AS BIGINT) AS bytes_sent"
    for name, source in (("increment_closed", ONE_SOURCE), ("increment_closed_by_source", BY_HOST)):
        statements[name] = with_log(
            f"SELECT source, {hour} AS time, vhost, protocol, loctag, {hits} FROM ({closed_requests}) GROUP BY {_BASE}",
            source=source,
        )
    statements["increment_leftover"] = with_log(
        f"SELECT source, {hour} AS time, vhost, protocol, loctag, {hits} FROM requests WHERE NOT ({_CLOSED}) "
        f"GROUP BY {_BASE}"
    )
    closed_points = points_sql(
        f"SELECT measurement, {hour} AS time, {columns} FROM points",
        where=f"bucket <= (SELECT max(bucket) - {_LOOKBACK} FROM requests)",
    )
    statements["increment_two_runs"] = closed_points
    statements["merged_points"] = closed_points
    statements["start_over_runs"] = closed_points
    statements["stream_closed_buckets"] = closed_points
    statements["stream_runs"] = closed_points

    daily = (
        "sends AS (SELECT *, CAST(ceil(bucket / 24.0) AS BIGINT) AS run FROM points), "
        "ranked AS (SELECT *, dense_rank() OVER (ORDER BY run DESC) AS r, max(run) OVER () AS newest FROM sends)"
    )
    statements["outbox_retain"] = points_sql(
        "SELECT run, measurement, count(*) AS points FROM ranked WHERE r <= 10 GROUP BY run, measurement", more=daily
    )
    statements["outbox_replay"] = points_sql(
        "SELECT run, run < newest AS resent, count(*) AS points FROM ranked WHERE r <= 11 GROUP BY ALL", more=daily
    )
    statements["replayed_delivery"] = points_sql(
        "SELECT count(*) AS got, count(*) AS listed, count(*) AS delivered FROM points",
        where=f"bucket <= (SELECT max(bucket) - {_LOOKBACK} FROM requests)",
    )
    statements["run_stats"] = points_sql(
        "SELECT (SELECT count(*) FROM parsed) AS parsed_lines, "
        "(SELECT count(*) FROM parsed WHERE reason IS NOT NULL) AS skipped_lines, "
        "count(*) AS sent_points, CAST(0 AS BIGINT) AS resent_points FROM points",
        where=f"bucket <= (SELECT max(bucket) - {_LOOKBACK} FROM requests)",
    )
    statements["stream_run_stats"] = with_log(
        "SELECT count(*) AS parsed_lines, count(*) FILTER (reason IS NOT NULL) AS skipped_lines FROM parsed"
    )
    statements["run_stats_line"] = points_sql(
        "SELECT 'run_stats,host=web1 parsed_lines=' || (SELECT count(*) FROM parsed) || 'i,sent_points=' || count(*) "
        "|| 'i,skipped_lines=' || (SELECT count(*) FROM parsed WHERE reason IS NOT NULL) || 'i ' "
        f"|| (SELECT max(bucket) * {_DURATION} // 60 FROM requests) AS line FROM points",
        where=f"bucket <= (SELECT max(bucket) - {_LOOKBACK} FROM requests)",
    )
    statements["capped_runs"] = with_log(
        f"SELECT source, {hour} AS time, vhost, protocol, loctag, {hits} FROM requests GROUP BY {_BASE}", source=BY_HOST
    )
    by_host = with_log(
        f"SELECT source, {hour} AS time, vhost, protocol, loctag, {hits} FROM requests GROUP BY {_BASE}", source="'web' || (user_id % 12)"
    )
    statements["rotated_runs"] = statements["growing_log"] = by_host
    statements["torn_lines"] = by_host.replace("CASE WHEN event_id % 97 = 0 THEN '2' ELSE '1' END,", "'1',")
    statements["wide_numbers"] = _WIDE_NUMBERS
    statements["stream_sources"] = with_log(_SOURCE_COUNTS, more=_SOURCES)
    statements["field_texts"] = _FIELD_TEXTS
    statements["stream_rejects"] = statements["run_rejects"] = with_log("SELECT source, value AS line, reason FROM parsed WHERE reason IS NOT NULL")
    statements["increment_late"] = with_log(_LATE_COUNTS, more=_LATE)
    statements["large_sums"] = _LARGE_SUMS
    statements["long_upstream_lists"] = _SUPPLIER_LISTS
    statements["log_scan"] = with_log(
        "SELECT source, count(*) AS lines, CAST(sum(length(value)) AS BIGINT) AS characters FROM log GROUP BY source"
    )
    statements["per_contact_upstreams"] = with_log(
        f"SELECT {hour} AS time, vhost, protocol, loctag, server AS upstream, count(*) AS contacts, "
        + ", ".join(
            f"CASE WHEN count({k}) > 0 THEN {_micro_mean(k)} END AS {k}_time_mean"
            for k in ("response", "connect", "header")
        )
        + " FROM contacts GROUP BY source, bucket, vhost, protocol, loctag, server"
    )
    day = time_text("bucket", _ORDER_DURATION)
    statements["order_contacts_means"] = (
        f"WITH {_ORDER_CONTACTS.strip()} SELECT {day} AS time, upstream, CAST(sum(n) AS BIGINT) AS hits, "
        "CAST(sum(n * us) AS DOUBLE) / CAST(sum(n * c) * 1000000 AS DOUBLE) AS response_time_mean "
        "FROM sums GROUP BY bucket, upstream"
    )
    statements["order_contacts_status"] = (
        f"WITH {_ORDER_CONTACTS.strip()} SELECT {day} AS time, upstream, status, CAST(sum(n) AS BIGINT) AS hits "
        "FROM (SELECT DISTINCT request, bucket, upstream, status FROM contacts) JOIN sums "
        "USING (request, bucket, upstream) GROUP BY bucket, upstream, status"
    )
    return statements
