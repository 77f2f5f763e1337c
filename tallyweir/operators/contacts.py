"""Upstream contacts of requests: one row per contact, and the per-request summary.

A server met ``n`` times in one request has its times and statuses counted
``n`` times over: each contact carries ``weight = n``, and the first contact
with a given (server, status) carries the ``n`` hits of that status.  Both are
worked out inside the row, so no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyweir.functions import upstreams as U
from tallyweir.functions.numbers import micros

WEIGHTINGS = ("per_request", "per_contact")
TIMES = ("response", "connect", "header")

# Not the bare column: for that the optimizer adds a filter, which it moves below the parse
# together with a copy of the parse.
ALL_CONTACTS = "coalesce(contacts, array())"
ACCEPTED_CONTACTS = "CASE WHEN reason IS NULL THEN contacts END"

CONTACT_COLUMNS = ("upstream", "upstream_status", "weight", "status_hits", "response_us", "connect_us", "header_us")


def explode_contacts(
    parsed: DataFrame,
    keys: list[str],
    weighting: str = "per_request",
    rows: str = ACCEPTED_CONTACTS,
    first: int = 1,
) -> DataFrame:
    """``keys``, ``at`` and ``CONTACT_COLUMNS``, one row per contact of accepted lines.

    ``rows`` is the array to explode and ``first`` the position of its first entry:
    0 if the contacts follow one NULL entry that stands for the request itself.
    """
    if weighting not in WEIGHTINGS:
        raise ValueError(f"weighting must be one of {WEIGHTINGS}: {weighting!r}")
    servers = "contacts.server"
    repeated = f"size(contacts) > 1 AND size(array_distinct({servers})) < size(contacts)"
    if weighting == "per_contact":
        repeated = "false"
    # Worked out before the contacts become rows, which then carry two numbers and not each other: sorted by server and
    # status, contacts of a server stand side by side.  Requests without a repeated server, nearly all, skip it.
    kept = [f"`{c}`" for c in parsed.columns]
    pairs = f"transform(contacts, (c, i) -> struct(c.server AS server, {U.normal_status('c.status')} AS status, i AS i))"
    known = _with_runs(parsed.selectExpr(*kept, f"CASE WHEN {repeated} THEN array_sort({pairs}) END AS _sorted"), kept)
    known = known.selectExpr(*kept, "_sorted", "flatten(transform(_lengths, n -> array_repeat(n, n))) AS _weights")
    kept = [c for c in kept if c != "`contacts`"]
    again = "k > 0 AND e.server <=> get(_sorted, k - 1).server AND e.status <=> get(_sorted, k - 1).status"
    numbered = (
        "CASE WHEN _sorted IS NULL OR _weights IS NULL "
        "THEN transform(contacts, (c, i) -> named_struct('entry', c, 'at', i, 'weight', 1L, 'again', false)) "
        "ELSE transform(_sorted, (e, k) -> named_struct('entry', get(contacts, e.i), 'at', e.i, "
        f"'weight', bigint(get(_weights, k)), 'again', {again})) END"
    )
    exploded = known.selectExpr(*kept, f"{numbered} AS contacts").selectExpr(*keys, f"explode({rows}) AS _contact")
    return exploded.selectExpr(
        *keys,
        # the entry that stands for the request itself comes before all contacts
        f"coalesce(_contact.at + 1, {first}) AS at",
        "_contact.entry.server AS upstream",
        f"{U.normal_status('_contact.entry.status')} AS upstream_status",
        "_contact.weight AS weight",
        "CASE WHEN _contact.again THEN 0L ELSE _contact.weight END AS status_hits",
        *[f"{micros(U.time_value(f'_contact.entry.{t}'))} AS {t}_us" for t in TIMES],
    )


def _with_runs(frame: DataFrame, kept: list[str]) -> DataFrame:
    """Add where the runs of equal servers begin in ``_sorted`` and their lengths, step by step, each in linear time.

    Every step uses what the one before made more than once, so the optimizer does not move it into a lambda.
    """
    begins = "filter(sequence(0, size(_sorted) - 1), k -> k = 0 OR NOT (get(_sorted, k).server <=> get(_sorted, k - 1).server))"
    begun = frame.selectExpr(*kept, "_sorted", f"CASE WHEN size(_sorted) > 0 THEN {begins} END AS _begins")
    lengths = "transform(_begins, (b, j) -> coalesce(get(_begins, j + 1), size(_sorted)) - b)"
    return begun.selectExpr(*kept, "_sorted", "_begins", f"{lengths} AS _lengths")


def contact_rows(requests: DataFrame, *keys: str) -> DataFrame:
    """One typed row per contact of each request, in list order from position 1."""
    exploded = requests.selectExpr(*keys, f"posexplode({ALL_CONTACTS}) AS (_at, _contact)")
    return exploded.selectExpr(
        *keys,
        "_at + 1 AS position",
        "_contact.server AS server",
        f"{U.normal_status('_contact.status')} AS status",
        *[f"{U.time_value(f'_contact.{t}')} AS {t}" for t in TIMES],
    )


def request_summary(requests: DataFrame, *keys: str) -> DataFrame:
    """One row per request and distinct server.

    Holds the contact count ``n``, for each time kind its sum in micro-units and
    its count, and the distinct statuses with how often each occurs.
    """
    sorted_by = "array_sort(transform(contacts, (c, i) -> struct(c.server AS server, i AS i)))"
    runs = _with_runs(requests.selectExpr(*keys, "contacts", f"{sorted_by} AS _sorted"), [*keys, "contacts"])
    own = "transform(slice(_sorted, b + 1, get(_lengths, j)), e -> get(contacts, e.i))"
    per_server = runs.selectExpr(
        *keys, f"explode(transform(_begins, (b, j) -> named_struct('server', get(_sorted, b).server, 'own', {own}))) AS _met"
    ).selectExpr(*keys, "_met.server AS server", "_met.own AS _own")
    per_server = per_server.selectExpr("*", f"array_sort(transform(_own, c -> {U.normal_status('c.status')})) AS _statuses")
    # where each status begins among the sorted ones
    per_server = per_server.selectExpr(
        "*", "filter(sequence(0, size(_statuses) - 1), k -> k = 0 OR get(_statuses, k) <> get(_statuses, k - 1)) AS _firsts"
    )
    typed = per_server.selectExpr(
        *keys,
        "server",
        "size(_own) AS n",
        "_statuses",
        "_firsts",
        *[
            f"filter(transform(_own, c -> {micros(U.time_value(f'c.{t}'))}), t -> t IS NOT NULL) AS _{t}" for t in TIMES
        ],
    )
    sums = [
        part
        for t in TIMES
        for part in (f"aggregate(_{t}, CAST(0 AS DECIMAL(38, 0)), (a, t) -> CAST(a + t AS DECIMAL(38, 0))) AS {t}_us", f"size(_{t}) AS {t}_n")
    ]
    statuses = (
        "transform(_firsts, (b, j) -> named_struct('status', get(_statuses, b), "
        "'n', coalesce(get(_firsts, j + 1), size(_statuses)) - b)) AS statuses"
    )
    return typed.selectExpr(*keys, "server", "n", *sums, statuses)
