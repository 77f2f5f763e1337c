"""Log lines to checked requests, one narrow projection after another.

``parse_lines`` keeps every line and gives each a ``reason``: NULL for an
accepted request, otherwise the first check that failed.  ``accepted`` and
``rejected`` choose by it.  Nothing here shuffles.

The acceptance test is a generator, not a ``filter``.  The optimizer moves a
filter below the projections that compute its inputs and substitutes them, so
the whole parse would run twice, once to test and once to project.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyweir.functions import upstreams as U
from tallyweir.functions.buckets import bucket_of
from tallyweir.functions.numbers import decimal_number, integer

# The line format, by position.
LINE_FIELDS = (
    "version",
    "msec",
    "vhost",
    "protocol",
    "loctag",
    "status",
    "bytes_sent",
    "gzip_ratio",
    "request_length",
    "request_time",
    "upstream_addr",
    "upstream_status",
    "upstream_response_time",
    "upstream_connect_time",
    "upstream_header_time",
)
LINE_VERSION = "1"
FIELD_SEPARATOR = r"\|"

# Reject reasons in the order of evaluation.
REJECT_REASONS = (
    "bad_version",
    "bad_msec",
    "late",
    "short_line",
    "bad_status",
    "bad_bytes_sent",
    "bad_request_length",
    "bad_gzip_ratio",
    "bad_request_time",
    "bad_upstream",
)
REASONS_BEFORE_LATE = ("bad_version", "bad_msec")

# Last second of the year 9999, the last one a time text can show.
LAST_SECOND = 253_402_300_799.0

REQUEST_COLUMNS = (
    "msec",
    "bucket",
    "vhost",
    "protocol",
    "loctag",
    "status",
    "bytes_sent",
    "gzip_ratio",
    "request_length",
    "request_time",
    "servers_contacted",
    "internal_redirects",
    "upstreams_servers",
    "contacts",
)

# The upstream lists: the name of an entry in a contact, and the field it comes from.
_LISTS = dict(zip(("server", "status", "response", "connect", "header"), LINE_FIELDS[10:]))
_TIMES = ("response", "connect", "header")


def parse_lines(
    lines: DataFrame, bucket_duration: int = 60, late_before: float = 0.0, line: str = "value"
) -> DataFrame:
    """Parse the text column ``line``; other columns pass through.

    Adds ``REQUEST_COLUMNS`` and ``reason``.  A line is late when its time is
    not strictly after ``late_before``.  ``contacts`` is NULL for a request
    without upstream, otherwise one struct of still textual entries per contact.
    """
    kept = [f"`{c}`" for c in lines.columns]
    plain = ("vhost", "protocol", "loctag", "status", "bytes_sent", "gzip_ratio", "request_length", "request_time")
    carried = [*kept, "_version", "_width", "msec", *plain, "_gzip_ratio", "_request_time"]
    lists = [f"_{name}_list" for name in _LISTS]

    return (
        lines.selectExpr(*kept, rf"split(`{line}`, r'{FIELD_SEPARATOR}') AS _fields")
        .selectExpr(*kept, *_typed_fields())
        .selectExpr(
            *[c for c in carried if c != "msec"],
            f"CASE WHEN abs(_msec) <= {LAST_SECOND!r}D THEN _msec END AS msec",
            "_server",
            *[f"{U.split_contacts(f'_{name}')} AS _{name}_list" for name in _LISTS],
        )
        .selectExpr(*carried, "_server", *lists, f"least({', '.join(f'array_size({c})' for c in lists)}) AS _kept")
        .selectExpr(*carried, "_server", f"{_zipped()} AS contacts")
        .selectExpr(
            *kept,
            "msec",
            f"{bucket_of('msec', bucket_duration)} AS bucket",
            *plain,
            f"CASE WHEN _server IS NOT NULL THEN {U.servers_contacted('_server')} END AS servers_contacted",
            f"CASE WHEN _server IS NOT NULL THEN {U.internal_redirects('_server')} END AS internal_redirects",
            "array_size(contacts) AS upstreams_servers",
            "contacts",
            f"{_reason(late_before)} AS reason",
        )
    )


def _typed_fields() -> list[str]:
    at = {name: f"get(_fields, {i})" for i, name in enumerate(LINE_FIELDS)}
    # the last field keeps the line end where the reader leaves it
    lists = {**at, "upstream_header_time": f"trim(TRAILING '\\r\\n' FROM {at['upstream_header_time']})"}
    return [
        f"{at['version']} AS _version",
        "array_size(_fields) AS _width",
        f"{decimal_number(at['msec'])} AS _msec",
        *[f"{at[name]} AS {name}" for name in ("vhost", "protocol", "loctag")],
        f"{integer(at['status'])} AS status",
        f"{integer(at['bytes_sent'])} AS bytes_sent",
        f"{decimal_number(at['gzip_ratio'])} AS gzip_ratio",
        f"{at['gzip_ratio']} AS _gzip_ratio",
        f"{integer(at['request_length'])} AS request_length",
        f"{decimal_number(at['request_time'])} AS request_time",
        f"{at['request_time']} AS _request_time",
        *[
            f"CASE WHEN {at['upstream_addr']} <> '{U.NONE_MARKER}' THEN {lists[field]} END AS _{name}"
            for name, field in _LISTS.items()
        ],
    ]


def _zipped() -> str:
    # A lambda keeps this step out of whole-stage code generation, on purpose: the steps
    # before and after it then compile to methods small enough for the JIT, which the
    # whole parse in a single method is not.
    entries = ", ".join(f"'{name}', get(_{name}_list, i)" for name in _LISTS)
    return f"transform(slice(_server_list, 1, _kept), (server, i) -> named_struct({entries}))"


def _reason(late_before: float) -> str:
    valid_lists = " AND ".join([U.valid_statuses("contacts.status"), *[U.valid_times(f"contacts.{t}") for t in _TIMES]])
    failed = {
        "bad_version": f"_version <> '{LINE_VERSION}'",
        "bad_msec": "_width > 1 AND msec IS NULL",
        "late": f"msec <= {float(late_before)!r}D",
        "short_line": f"_width < {len(LINE_FIELDS)}",
        "bad_status": "status IS NULL",
        "bad_bytes_sent": "bytes_sent IS NULL",
        "bad_request_length": "request_length IS NULL",
        "bad_gzip_ratio": f"gzip_ratio IS NULL AND _gzip_ratio <> '{U.NONE_MARKER}'",
        "bad_request_time": f"request_time IS NULL AND _request_time <> '{U.NONE_MARKER}'",
        "bad_upstream": f"contacts IS NOT NULL AND NOT ({valid_lists})",
    }
    cases = " ".join(f"WHEN {failed[name]} THEN '{name}'" for name in REJECT_REASONS)
    return f"CASE {cases} END"


def keep_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows where ``condition`` is true, without copying its inputs below the projections."""
    return df.selectExpr("*", f"explode(CASE WHEN {condition} THEN array(1) END) AS _once").drop("_once")


def accepted(parsed: DataFrame) -> DataFrame:
    """The requests: every line that passed all checks."""
    return keep_where(parsed, "reason IS NULL").drop("reason")


def rejected(parsed: DataFrame, line: str = "value") -> DataFrame:
    """The skipped lines with their reason, the other columns passed through."""
    passed_through = [c for c in parsed.columns if c not in (*REQUEST_COLUMNS, "reason", line)]
    return keep_where(parsed.select(*passed_through, line, "reason"), "reason IS NOT NULL")
