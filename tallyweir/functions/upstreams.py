"""The upstream lists of one request.

Five parallel text lists describe the servers a request was passed to.  Groups
are separated by ``", "``; an internal redirect adds ``" : "`` inside a group.
Only the positions present in *all* five lists count.
"""

from __future__ import annotations

from tallyweir.functions.numbers import (
    DECIMAL_PATTERN,
    INTEGER_PATTERN,
    LARGEST_NUMBER,
    PLAIN_DECIMAL_PATTERN,
    integer_text,
)

NONE_MARKER = "-"
GROUP_SEPARATOR = ", "
REDIRECT_SEPARATOR = " : "

# Cutting at either separator in one left-to-right scan equals cutting at groups
# first and at redirects second: where the two overlap, the comma comes first.
EITHER_SEPARATOR = "(?:, | : )"
# One entry each: lists are checked entry by entry, as a pattern over a whole list would nest with its length.
_STATUS = rf"^(?:\s*{INTEGER_PATTERN}\s*|-)$"
_PLAIN_TIME = rf"^(?:\s*{PLAIN_DECIMAL_PATTERN}\s*|-|)$"
_TIME = rf"^\s*{DECIMAL_PATTERN}\s*$"


def split_contacts(text: str) -> str:
    """Flat array of the entries of one upstream list."""
    return f"split({text}, '{EITHER_SEPARATOR}')"


def servers_contacted(addresses: str) -> str:
    """Number of address groups, whether or not the other lists are as long."""
    return f"size(split({addresses}, '{GROUP_SEPARATOR}'))"


def internal_redirects(addresses: str) -> str:
    """Number of address groups with at least one internal redirect."""
    return f"size(filter(split({addresses}, '{GROUP_SEPARATOR}'), g -> contains(g, '{REDIRECT_SEPARATOR}')))"


def valid_statuses(entries: str) -> str:
    """True when all statuses of an array are whole numbers or ``-``."""
    return f"forall({entries}, e -> e RLIKE r'{_STATUS}')"


def valid_times(entries: str) -> str:
    """True when all times of an array are decimals in range, ``-`` or empty."""
    number = f"abs(try_cast(e AS DOUBLE)) <= {LARGEST_NUMBER!r}D"
    return f"forall({entries}, e -> e RLIKE r'{_PLAIN_TIME}' OR (e RLIKE r'{_TIME}' AND {number}))"


def normal_status(text: str) -> str:
    """Status key of a valid status entry: ``-`` or the plain whole number."""
    return f"CASE WHEN {text} = '{NONE_MARKER}' THEN {text} ELSE {integer_text(text)} END"


def time_value(text: str) -> str:
    """DOUBLE of a valid time entry; ``-`` and the empty text give NULL."""
    return f"CASE WHEN {text} NOT IN ('{NONE_MARKER}', '') THEN try_cast({text} AS DOUBLE) END"
