"""Secrets in texts: fixed forms, and values that are costly to guess where credentials stand.

The cost of a value is that of its cheapest division into words, dates, repeats, keyboard walks and spans that are
tried out by brute force, found by dynamic programming over its characters.  Costs are in bits: the logarithm of the
number of guesses.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from math import inf, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.shared import kept

# The base forms.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "guess")

#: Names of credentials beyond the base form, which also takes fewer characters.
_NAMES = ("password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "credential", "credentials", "apikey", "api_key", "api-key", "access_key", "access-key", "private_key", "auth", "authorization")
_VALUE = r"""(?:"([^"\r\n]+)"|'([^'\r\n]+)'|([^\s"']\S*))"""
CONTEXT = re.compile(
    rf"""(?<![A-Za-z])(?:{'|'.join(sorted(_NAMES, key=len, reverse=True))})["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:bearer[\x20\t]+|basic[\x20\t]+)?{_VALUE}""",
    re.IGNORECASE | re.ASCII,
)
#: The password of a URL.
URL_LOGIN = re.compile(r"://[^\s/:@]+:([^\s/:@]+)@")
_HINTS = ("pass", "pwd", "secret", "token", "credential", "api", "access", "private", "auth")
_ENDS = ".,;:!?)]}>\"'"
#: A call or an entry of something that has a name, as in code: a value that is fetched, not the value itself.
_FETCHED = re.compile(r"[A-Za-z_][\w.]*[(\[]", re.ASCII)

#: A value is a secret from so many bits on, and so many for each character.
LEAST_BITS = 34.0
LEAST_DENSITY = 3.0
LEAST_LENGTH = 8
#: Bits of every further segment: where it ends.
SEGMENT_BITS = 1.0
#: What joins words counts as one of as many words.
JOINTS = " _-."
SHORTEST_WORD, SHORTEST_WALK, LONGEST_PERIOD = 3, 4, 64
# Keys of a keyboard, row by row, with how far each row is moved to the right.
KEY_ROWS = (("1234567890-=", 0.0), ("qwertyuiop[]", 0.5), ("asdfghjkl;'", 0.75), ("zxcvbnm,./", 1.25))
# Characters that stand for letters; two of them for one of two letters.
LEET = ("4a", "@a", "8b", "3e", "6g", "1i", "!i", "0o", "$s", "5s", "7t", "+t", "2z"), ("1l", "|l")
_DATE = re.compile(
    r"(?=(?P<y>(?:19|20)\d\d)(?P<s>[-/._]?)(?P<m>0?[1-9]|1[0-2])(?P=s)(?P<d>3[01]|[12]\d|0?[1-9]))"
    r"|(?=(?P<a>3[01]|[12]\d|0?[1-9])(?P<t>[-/._]?)(?P<b>3[01]|[12]\d|0?[1-9])(?P=t)(?P<z>(?:19|20)\d\d))",
    re.ASCII,
)
_YEAR = re.compile(r"(?=((?:19|20)\d\d))", re.ASCII)
_MIDDLE_YEAR, _LEAST_YEARS = 2000, 20


class Guesser:
    """Costs of values, by a list of words that begins with the most frequent."""

    def __init__(self, words: list[str]):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for rank, word in enumerate(words, 1):
            if word not in self.words:
                self.words.add_word(word, (len(word), log2(rank)))
        self.has_words = len(self.words) > 0
        if self.has_words:
            self.words.make_automaton()
        one = {ord(k[0]): k[1] for k in LEET[0]}
        self.leet = one, one | {ord(k[0]): k[1] for k in LEET[1]}
        place = {key: (row, shift + i) for row, (keys, shift) in enumerate(KEY_ROWS) for i, key in enumerate(keys)}
        self.near = {
            (a, b): (x[0] - y[0], x[1] < y[1])
            for a, x in place.items() for b, y in place.items()
            if a != b and abs(x[0] - y[0]) <= 1 and abs(x[1] - y[1]) <= 1
        }
        self.key_bits = log2(len(place))

    def bits(self, value: str) -> float:
        """The cost of the cheapest division of the whole value."""
        return self._cheapest(value, self._segments(value))

    def _cheapest(self, value: str, segments: list[tuple[int, int, float]]) -> float:
        starts: dict[int, list[tuple[int, float]]] = {}
        for start, end, bits in segments:
            starts.setdefault(end, []).append((start, bits))
        each = brute_force_bits(value)
        best, brute = [0.0] + [inf] * len(value), [inf] * (len(value) + 1)
        for end in range(1, len(value) + 1):
            extra = SEGMENT_BITS if end > 1 else 0.0
            brute[end] = each + min(brute[end - 1], best[end - 1] + extra)
            best[end] = min([brute[end], *(best[start] + bits + (SEGMENT_BITS if start else 0.0) for start, bits in starts.get(end, ()))])
        return best[-1]

    def _segments(self, value: str, repeats: bool = True) -> list[tuple[int, int, float]]:
        """Start, end and bits of everything that is cheaper than trying out."""
        joints = [(i, i + 1, log2(len(JOINTS))) for i, c in enumerate(value) if c in JOINTS]
        return [*joints, *self._words(value), *dates(value), *self._walks(value), *(self._repeats(value) if repeats else ())]

    def _words(self, value: str) -> Iterator[tuple[int, int, float]]:
        if not self.has_words:
            return
        plain = value.lower()
        if len(plain) != len(value):
            plain = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        n = len(value)
        for text in {plain, plain.translate(self.leet[0]), plain.translate(self.leet[1])}:
            for backwards in (False, True):
                for last, (length, bits) in self.words.iter(text[::-1] if backwards else text):
                    start, end = (n - last - 1, n - last - 1 + length) if backwards else (last + 1 - length, last + 1)
                    changed = sum(a != b for a, b in zip(text[start:end], plain[start:end]))
                    yield start, end, bits + backwards + changed + capital_bits(value[start:end])

    def _walks(self, value: str) -> Iterator[tuple[int, int, float]]:
        plain = value.lower()
        if len(plain) != len(value):
            return
        for start in range(len(plain)):
            if start and (plain[start - 1], plain[start]) in self.near:
                continue
            end, turns, way = start + 1, 0, None
            while end < len(plain) and (step := self.near.get((plain[end - 1], plain[end]))) is not None:
                turns += step != way
                way = step
                end += 1
                if end - start >= SHORTEST_WALK:
                    yield start, end, self.key_bits + log2(end - start) + turns * log2(6) + capital_bits(value[start:end])

    def _repeats(self, value: str) -> Iterator[tuple[int, int, float]]:
        codes = np.frombuffer(value.encode("utf-32-le", "replace"), dtype=np.uint32)
        for period in range(1, min(LONGEST_PERIOD, len(value) // 2) + 1):
            same = np.concatenate([[False], codes[period:] == codes[:-period], [False]])
            edges = np.flatnonzero(same[1:] != same[:-1])
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                times = (end - start) // period + 1
                if times > 1:
                    unit = value[start : start + period]
                    bits = self._cheapest(unit, self._segments(unit, repeats=False))
                    for n in range(2, times + 1):
                        yield start, start + n * period, bits + log2(n)


def brute_force_bits(value: str) -> float:
    """Bits of a character that is tried out, by the classes of characters that the value has."""
    has = {"lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "sign" if c < "\x80" else "other" for c in value}
    return log2(sum({"lower": 26, "upper": 26, "digit": 10, "sign": 33, "other": 100}[h] for h in has) or 1)


def capital_bits(word: str) -> float:
    """Bits for which letters are capitals."""
    capitals = sum(c.isupper() for c in word)
    if not capitals:
        return 0.0
    if capitals == 1 and word[0].isupper() or not any(c.islower() for c in word):
        return 1.0
    return float(min(len(word), 2 * capitals))


def dates(value: str) -> Iterator[tuple[int, int, float]]:
    """Years, and dates with the year first or last."""
    for match in _YEAR.finditer(value):
        yield match.start(), match.start() + 4, log2(max(abs(int(match[1]) - _MIDDLE_YEAR), _LEAST_YEARS))
    for match in _DATE.finditer(value):
        year, mark = (match["y"], match["s"]) if match["y"] else (match["z"], match["t"])
        parts = (match["m"], match["d"]) if match["y"] else (match["a"], match["b"])
        length = 4 + 2 * len(mark) + sum(map(len, parts))
        yield match.start(), match.start() + length, log2(366 * max(abs(int(year) - _MIDDLE_YEAR), _LEAST_YEARS)) + (2.0 if mark else 0.0)


@lru_cache(maxsize=2)
def word_list(path: str) -> tuple[str, ...]:
    """The whole words of a public vocabulary with marks at their ends, in the order of their merges."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = (piece.removesuffix("</w>") for piece in sorted(vocabulary, key=vocabulary.get) if piece.endswith("</w>"))
    return tuple(w for w in words if len(w) >= SHORTEST_WORD and w.isascii() and w.isalpha())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Start, place of the kind, end and value of the fixed forms."""
    out = [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    return out


def _candidates(text: str) -> Iterator[tuple[int, int, bool]]:
    """Start and end of values in the context of credentials, and whether they are quoted."""
    for match in CONTEXT.finditer(text):
        group = next(g for g in (1, 2, 3) if match[g] is not None)
        start, end = match.span(group)
        if group == 3:
            end = start + len(match[3].rstrip(_ENDS))
        yield start, end, group < 3
    for match in URL_LOGIN.finditer(text):
        yield *match.span(1), True


def costly(guesser: Guesser, value: str, quoted: bool) -> float | None:
    """The bits of a value that is a secret, otherwise nothing.

    Prose is none, as it is not costly per character; outside quotes letters alone and calls are none either.
    """
    if len(value) < LEAST_LENGTH or "://" in value or not quoted and (value.isalpha() or _FETCHED.match(value)):
        return None
    bits = guesser.bits(value)
    return bits if bits >= max(LEAST_BITS, LEAST_DENSITY * len(value)) else None


def spans_of(guesser: Guesser, text: str) -> list[tuple[str, int, int, float]]:
    """Kind, start, end (exclusive) and bits of all spans of a text, by start, then by kind."""
    low = text.lower()
    hinted = any(hint in low for hint in _HINTS)
    found = base_spans(text) if hinted or "AKIA" in text else [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    out = [(start, kind, end, guesser.bits(value)) for start, kind, end, value in found]
    if hinted or "://" in text:
        taken = sorted((start, end) for start, _, end, _ in out)
        last = 0
        for start, end, quoted in sorted(_candidates(text)):
            if start >= last and not any(a < end and start < b for a, b in taken):
                bits = costly(guesser, text[start:end], quoted)
                if bits is not None:
                    out.append((start, 3, end, bits))
                    last = end
    return [(KINDS[kind], start, end, bits) for start, kind, end, bits in sorted(out)]


SPANS = "array<struct<kind: string, start: bigint, end: bigint, bits: double>>"


def secrets(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) as ``doc_id`` and ``found``: kind, start, end and bits of every secret.

    Starts and ends count code points of the whole text; spans are ordered by start, then by kind: ``assign``,
    ``access`` and ``hex`` are the fixed forms, each leftmost and without overlap within its kind, and always stay;
    ``guess`` are further values where credentials stand that cost ``LEAST_BITS``, and ``LEAST_DENSITY`` for every
    character; they overlap no other span.  A null text counts as empty and has none; a null or repeated ``doc_id``
    is kept, every row for itself; an empty table gives no rows; other columns are ignored.  Nothing is shuffled;
    ``vocabulary`` is read by every worker.
    """

    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        guesser = kept(("guesscost", vocabulary), lambda: Guesser(list(word_list(vocabulary))))
        for batch in batches:
            yield pd.Series([[dict(zip(("kind", "start", "end", "bits"), s)) for s in spans_of(guesser, t or "")] for t in batch], dtype=object)

    return docs.select(F.col("doc_id").cast("bigint"), F.pandas_udf(scanned, SPANS)("text").alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of the fixed forms, hash of their spans, all spans as text and how many were added."""
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(found, s -> s.kind <> 'guess')"
    count = "bigint(size(filter(found, s -> s.kind = '{0}'))) AS n_{0}"
    return found.selectExpr(
        "doc_id", *[count.format(kind) for kind in KINDS[:3]], f"sha2({text.format(base)}, 256) AS base_sha256",
        f"{text.format('found')} AS spans", count.format("guess"),
    )
