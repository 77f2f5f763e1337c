r"""Rendering of points as line-protocol text.

``\`` in the SQL literals below stands for itself where the literal is raw (``r'...'``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

# Seconds, or parts of a second, per time precision.
UNITS_PER_SECOND = {"n": 1_000_000_000, "u": 1_000_000, "ms": 1_000, "s": 1}
SECONDS_PER_UNIT = {"m": 60, "h": 3_600}

_SPECIAL = r"([\\ ,=])"
_MARKED = r"\\$1"


def literal(text: str) -> str:
    """SQL literal of any text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def escape_name(text: str) -> str:
    """Escape a measurement, tag name or field name: backslash, blank, comma, equals sign, newline."""
    marked = f"regexp_replace({text}, {literal(_SPECIAL)}, {literal(_MARKED)})"
    return f"replace({marked}, {literal(chr(10))}, {literal(chr(92) + 'n')})"


def escape_tag_value(text: str) -> str:
    """Escape a tag value; a blank follows a final backslash so it cannot eat the separator."""
    escaped = escape_name(text)
    return f"concat({escaped}, CASE WHEN endswith({text}, {literal(chr(92))}) THEN ' ' ELSE '' END)"


def integer_field(value: str) -> str:
    return f"concat(string(bigint({value})), 'i')"


# From which power of ten on, and up to which, a number is written without exponent.
_LEAST_PLAIN, _MOST_PLAIN = -4, 15


def float_field(value: str) -> str:
    """The shortest text that reads back as the same DOUBLE; NULL for what is no finite number.

    Numbers from 0.0001 to 10^16 are written out with at least one place, others as ``1.5e-07``.
    """
    number = f"double({value})"
    # up to 15 digits Spark's own text is the shortest; between these bounds it is written out
    common = f"abs({number}) >= 0.001D AND abs({number}) < 10000000D AND char_length(string({number})) <= 16"
    sign = f"CASE WHEN startswith(string({number}), '-') THEN '-' ELSE '' END"
    finite = f"abs({number}) < double('infinity')"
    return (
        f"CASE WHEN {common} THEN string({number}) WHEN {number} = 0 THEN concat({sign}, '0.0') "
        f"WHEN {finite} THEN concat({sign}, {_shortest(f'abs({number})')}) END"
    )


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _shortest(number: str) -> str:
    """Text of a positive number from its digits and the place of its point."""
    # Spark writes 0.00123, 123.4 or 1.234E10, sometimes with a digit or two more than needed
    mantissa, exponent = "split_part(t, 'E', 1)", "coalesce(try_cast(split_part(t, 'E', 2) AS INT), 0)"
    whole = f"replace({mantissa}, '.', '')"
    lead = f"(char_length({whole}) - char_length(ltrim('0', {whole})))"
    digits = f"trim(BOTH '0' FROM {whole})"
    point = f"locate('.', t) - 1 + {exponent} - {lead}"
    parts = f"named_struct('d', {digits}, 'p', int({point}), 'x', double(t))"
    # the fewest digits, rounded or cut or one more, that still read as the number
    tries = ", ".join(
        f"CASE WHEN char_length(n.d) > {k} THEN named_struct('c', string((bigint(n.d) + {add}) div {10**k}), 'k', {k}) END"
        for k in (2, 1) for add in (5 * 10 ** (k - 1), 0, 10**k)
    )
    place = "n.p + char_length(e.c) - (char_length(n.d) - e.k)"
    same = f"e.c <> '0' AND double(concat('0.', e.c, 'E', {place})) = n.x"
    cut = f"named_struct('d', trim(TRAILING '0' FROM e.c), 'p', {place})"
    found = f"coalesce(get(transform(filter(array_compact(array({tries})), e -> {same}), e -> {cut}), 0), named_struct('d', n.d, 'p', n.p))"
    size = "char_length(m.d)"
    plain = (
        f"CASE WHEN m.p <= 0 THEN concat('0.', repeat('0', -m.p), m.d) "
        f"WHEN m.p >= {size} THEN concat(m.d, repeat('0', m.p - {size}), '.0') "
        "ELSE concat(substr(m.d, 1, m.p), '.', substr(m.d, m.p + 1)) END"
    )
    power = "lpad(string(abs(m.p - 1)), greatest(2, char_length(string(abs(m.p - 1)))), '0')"
    powered = f"concat(substr(m.d, 1, 1), CASE WHEN {size} > 1 THEN concat('.', substr(m.d, 2)) ELSE '' END, 'e', CASE WHEN m.p > 0 THEN '+' ELSE '-' END, {power})"
    shown = f"CASE WHEN m.p - 1 BETWEEN {_LEAST_PLAIN} AND {_MOST_PLAIN} THEN {plain} ELSE {powered} END"
    return _bound(f"string({number})", "t", _bound(parts, "n", _bound(found, "m", shown)))


def boolean_field(value: str) -> str:
    return f"CASE WHEN {value} THEN 'True' WHEN NOT {value} THEN 'False' END"


def text_field(value: str) -> str:
    for special, shown in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        value = f"replace({value}, {literal(special)}, {literal(shown)})"
    return f"concat('\"', {value}, '\"')"


def field_text(value: str, data_type: T.DataType) -> str:
    """Field text by column type; NULL stays NULL and is left out of the line."""
    if isinstance(data_type, T.BooleanType):
        return boolean_field(value)
    if isinstance(data_type, T.IntegralType):
        return integer_field(value)
    if isinstance(data_type, T.FractionalType):
        return float_field(value)
    return text_field(f"string({value})")


def tag_part(tags: str) -> str:
    """``,name=value`` for each tag of a map in name order; empty names and values are left out."""
    # Entries are structs led by the key, so their natural order is name order.
    shown = f"array_sort(filter(map_entries({tags}), e -> e.key <> '' AND e.value <> ''))"
    part = f"concat(',', {escape_name('e.key')}, '=', {escape_tag_value('e.value')})"
    return f"array_join(transform({shown}, e -> {part}), '')"


def known_tag_part(tags: Mapping[str, str]) -> str:
    """The same for tags whose names are known beforehand, each given as a text expression."""
    parts = [
        f"CASE WHEN {value} <> '' THEN concat(',', {escape_name(literal(name))}, '=', {escape_tag_value(value)}) "
        "ELSE '' END"
        for name, value in sorted(tags.items())
        if name
    ]
    return f"concat({', '.join(parts)})" if parts else "''"


def field_part(fields: Mapping[str, str]) -> str:
    """`` name=text,...`` in name order from ready field texts; empty when all are absent."""
    named = [f"concat({escape_name(literal(name))}, '=', {text})" for name, text in sorted(fields.items()) if name]
    joined = f"concat_ws(',', {', '.join(named)})" if named else "''"
    return f"CASE WHEN {joined} <> '' THEN concat(' ', {joined}) ELSE '' END"


def render_line(measurement: str, tags: str, fields: Mapping[str, str], time: str | None = None) -> str:
    """One line: measurement, a ready tag part, fields, and a time already in the wanted precision."""
    parts = [escape_name(measurement), tags, field_part(fields)]
    if time is not None:
        parts.append(f"coalesce(concat(' ', string(bigint({time}))), '')")
    return f"concat({', '.join(parts)})"


def time_in_precision(epoch_seconds: str, precision: str | None = None) -> str:
    """Epoch seconds, whole or fractional, floored to ``n``, ``u``, ``ms``, ``s``, ``m`` or ``h``."""
    precision = precision or "n"
    if precision in UNITS_PER_SECOND:
        return f"bigint(floor({epoch_seconds} * {UNITS_PER_SECOND[precision]}))"
    if precision in SECONDS_PER_UNIT:
        return f"bigint(floor({epoch_seconds} / {SECONDS_PER_UNIT[precision]}))"
    raise ValueError(f"a time precision is one of {sorted([*UNITS_PER_SECOND, *SECONDS_PER_UNIT])}, not {precision!r}")
