"""Text-to-number conversions with an explicit grammar.

Bare casts are too lenient for log text (``'1.5d'`` casts to 1.5), so decimals
are checked against a pattern first.  Integers of 64 bits need no pattern:
``try_cast`` to an integer type takes exactly optional blanks, a sign and digits.
Larger ones, and larger decimals, are read as exactly and only take longer.
"""

from __future__ import annotations

# Accepted number texts.
INTEGER_PATTERN = r"[+-]?\d+"
DECIMAL_PATTERN = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
# Decimals as logs write them, whose micro-units surely fit a BIGINT.
PLAIN_DECIMAL_PATTERN = r"[+-]?(?:\d{1,12}(?:\.\d*)?|\.\d+)"

# Above this, a value in micro-units no longer fits a BIGINT.
LARGEST_SHORT = 9.0e12
# Up to this, hundred million values in micro-units add up within 38 digits.
LARGEST_NUMBER = 1.0e24
# Digits of whole numbers, leading zeros apart, for the same reason.
LARGEST_DIGITS = 30


def integer(text: str) -> str:
    """DECIMAL(38, 0) value of ``text``, NULL when it is not a whole number of at most ``LARGEST_DIGITS`` digits."""
    return (
        f"coalesce(CAST(try_cast({text} AS BIGINT) AS DECIMAL(38, 0)), "
        f"CASE WHEN {text} RLIKE r'^\\s*[+-]?0*\\d{{1,{LARGEST_DIGITS}}}\\s*$' THEN try_cast({text} AS DECIMAL(38, 0)) END)"
    )


def integer_text(text: str) -> str:
    """A whole number of any length as plain text: no blanks, plus signs or leading zeros."""
    short = f"string(try_cast({text} AS BIGINT))"
    bare = f"regexp_replace({text}, r'^\\s*\\+?(-?)0*(\\d+)\\s*$', '$1$2')"
    return f"coalesce({short}, CASE WHEN {bare} RLIKE '^-?0+$' THEN '0' ELSE {bare} END)"


def decimal_number(text: str) -> str:
    """DOUBLE value of ``text``; NULL for other text and for values beyond ``LARGEST_NUMBER``."""
    # The cast comes after the test: casting text that is no number costs an exception each time.
    number = f"try_cast({text} AS DOUBLE)"
    return (
        f"CASE WHEN {text} RLIKE r'^\\s*{PLAIN_DECIMAL_PATTERN}\\s*$' THEN {number} "
        f"WHEN {text} RLIKE r'^\\s*{DECIMAL_PATTERN}\\s*$' "
        f"THEN CASE WHEN abs({number}) <= {LARGEST_NUMBER!r}D THEN {number} END END"
    )


def micros(number: str) -> str:
    """Whole micro-units of a DOUBLE as DECIMAL(38, 0), so that sums do not depend on row order."""
    short = f"CAST(floor({number} * 1000000D + 0.5D) AS DECIMAL(38, 0))"
    long = f"CAST(CAST({number} AS DECIMAL(38, 0)) * 1000000 AS DECIMAL(38, 0))"
    return f"CASE WHEN abs({number}) <= {LARGEST_SHORT!r}D THEN {short} WHEN {number} IS NOT NULL THEN {long} END"


def mean_from_micros(total: str, count: str) -> str:
    """Mean in natural units from a sum of micro-units; NULL when the count is 0."""
    return f"CASE WHEN {count} > 0 THEN double({total}) / ({count} * 1000000D) END"
