"""Format-preserving pseudonyms for personal data.

Numbers, dates and other values are found by their form and, where there is one, by their check digits.
Each is read as a position in the set of all values of its format and moved to another position by a keyed
Feistel network over exactly that set.  So a pseudonym has the format of its value and stays valid, equal
values get equal pseudonyms in all documents, and who has the key can undo it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.shared import kept, passed

ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"

# Groups of national telephone numbers, whose first digit is part of the form.
_GAP = "[ \u00a0\u202f.-]"
_SPACE = "[ \u00a0\u202f]"
_NATIONAL = "|".join((
    rf"0[0-9](?P<s5>{_GAP})[0-9]{{2}}(?:(?P=s5)[0-9]{{2}}){{3}}",  # 01 23 45 67 89
    rf"[6-9][0-9](?P<s6>{_GAP})[0-9]{{3}}(?P=s6)[0-9]{{2}}(?P=s6)[0-9]{{2}}",  # 91 123 45 67
    rf"[6-9][0-9]{{2}}(?P<s7>{_GAP})[0-9]{{2}}(?P=s7)[0-9]{{2}}(?P=s7)[0-9]{{2}}",  # 912 34 56 78
    # 612 345 678, but no amount as 650 000 000 or part of one
    rf"(?<![0-9]{_SPACE})(?P<thirds>[6-9][0-9]{{2}}{_SPACE}[0-9]{{3}}{_SPACE}(?!000)[0-9]{{3}})(?!{_SPACE}[0-9]{{3}})",
    rf"0[0-9](?P<s8>{_GAP})[0-9]{{4}}(?P=s8)[0-9]{{4}}",  # 02 1234 5678
    rf"0[0-9]{{2}}(?P<s9>{_GAP})[0-9]{{4}}(?P=s9)[0-9]{{4}}",  # 020 7946 0958
    rf"0[0-9]{{3}}(?P<s10>{_GAP})[0-9]{{3}}(?P=s10)[0-9]{{3,4}}",  # 0161 496 0000
    rf"\(0[0-9]{{1,4}}\){_GAP}?[0-9]{{2,4}}(?:{_GAP}?[0-9]{{2,4}}){{1,3}}",  # (020) 7946 0958
    rf"0[0-9]{{1,4}}(?:{_SPACE}?/{_SPACE}?|{_GAP})[0-9]{{3,8}}(?:{_GAP}[0-9]{{2,5}}){{0,2}}",  # 030/1234567
    r"[2-9][0-9]{2}-[0-9]{4}",  # 555-0199
))
# Forms of personal data.
FORMS = {
    "email": r"(?<![\w.+-])[\w.+-]*\w@[\w-]+(?:\.[\w-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}|[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
    rf"|(?<![0-9][.,/-])(?<![0-9]{{3}}{_SPACE})(?P<national>{_NATIONAL})(?![./-][0-9]))(?![0-9])",
    "card": r"(?<!\w)[0-9]{4}(?:(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{1,7}|(?P<s4>[ -])[0-9]{6}(?P=s4)[0-9]{4,5})(?![0-9])",
    "number": r"(?<!\w)[0-9]{9,19}(?![0-9])",
}
_ANY = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in FORMS.items()))
# Words before an unmarked number that tell that it belongs to a person, and before one that is no address.
_CUE = re.compile(
    r"(?<![^\W_])(?:phone|telephone|tel|mobile|cell|fax|call|account|acct|iban|card|ssn|social security|passport|licen[cs]e|insurance|tax|patient|customer|member|national id|id card"
    r"|telefon|handy|mobil|konto|kontonummer|ausweis|steuer|versicherung|kunde|kundennummer|t[eé]l[eé]phone|portable|compte|passeport|carte|s[eé]curit[eé] sociale"
    r"|tel[eé]fono|m[oó]vil|cuenta|pasaporte|tarjeta|dni|nie|nif)(?![^\W_])(?:[\s.:#=]|(?:no|nr|num|number|nummer|num[eé]ro|n[uú]mero|is|ist|est|es|at|unter|au|al|de|du|der)(?![^\W_])|n?[°º])*$",
    re.IGNORECASE,
)
_CUE_REACH = 60
_CARD_DIGITS = 16
_VERSION = re.compile(r"(?<![^\W_])(?:version|versi[oó]n|ver|v|release|build|firmware|section|§)[\s.:#]*$", re.IGNORECASE)
# No value of any form is without one of these.
_HINT = re.compile(r"[0-9@]")


class Found(NamedTuple):
    kind: str
    start: int
    end: int
    pseudonym: str


class Pseudonyms:
    """Pseudonyms under one key."""

    def __init__(self, key: bytes):
        self.key = key
        self.moved = lru_cache(maxsize=100_000)(self._moved)

    def permuted(self, value: int, size: int, tweak: str) -> int:
        """A keyed permutation of ``range(size)``, different for every tweak.

        An unbalanced Feistel network over the next rectangle of at least ``size`` places; places outside the
        range are walked through until one is inside.
        """
        if size < 2:
            return value
        high = 1 << (size - 1).bit_length() // 2
        low = -(-size // high)
        while True:
            left, right = divmod(value, low)
            for i in range(ROUNDS):
                if i % 2:
                    right = (right + self._round(tweak, i, left)) % low
                else:
                    left = (left + self._round(tweak, i, right)) % high
            value = left * low + right
            if value < size:
                return value

    def restored(self, value: int, size: int, tweak: str) -> int:
        """Undoes ``permuted``."""
        if size < 2:
            return value
        high = 1 << (size - 1).bit_length() // 2
        low = -(-size // high)
        while True:
            left, right = divmod(value, low)
            for i in reversed(range(ROUNDS)):
                if i % 2:
                    right = (right - self._round(tweak, i, left)) % low
                else:
                    left = (left - self._round(tweak, i, right)) % high
            value = left * low + right
            if value < size:
                return value

    def _round(self, tweak: str, i: int, half: int) -> int:
        message = f"{tweak}|{i}|{half}".encode()
        return int.from_bytes(hmac.digest(self.key, message, hashlib.sha256)[:16], "big")

    def _moved(self, text: str, alphabet: str, tweak: str) -> str:
        """A string over an alphabet, moved among all strings of its length."""
        base, value = len(alphabet), 0
        for c in text:
            value = value * base + alphabet.index(c)
        size = base ** len(text)
        moved = self.other(value, size, f"{tweak}|{len(text)}")
        out = []
        for _ in text:
            moved, i = divmod(moved, base)
            out.append(alphabet[i])
        return "".join(reversed(out))

    def other(self, value: int, size: int, tweak: str, rule: Callable[[int], bool] = lambda _: True) -> int:
        """The permuted value, walked on while ``rule`` refuses it.

        As the value itself satisfies the rule, this ends, and different values stay different.
        """
        out = self.permuted(value, size, tweak)
        while not rule(out):
            out = self.permuted(out, size, tweak)
        return out

    def pseudonym(self, kind: str, text: str, match: re.Match) -> str | None:
        """The pseudonym of a value, or None if it is no valid one of its kind."""
        return getattr(self, f"_{kind}")(text, match)

    def _email(self, text: str, _) -> str:
        name, domain = text.split("@", 1)
        return f"{self._characters(name, 'email')}@{self._characters(domain, 'domain', keep_last=True)}"

    def _characters(self, text: str, tweak: str, keep_last: bool = False) -> str:
        """Letters for letters and digits for digits, moved together; of a domain the last part stays."""
        head, dot, last = text.rpartition(".") if keep_last else (text, "", "")
        lowered = head.lower() if len(head.lower()) == len(head) else head
        form = "".join("a" if c in LETTERS else "9" if c in DIGITS else c for c in lowered)
        bases = [10 if c in DIGITS else 26 if c.isalnum() else 1 for c in lowered]
        value, size = 0, 1
        for c, base in zip(lowered, bases):
            # other letters become one of a to z; which letters they are is part of the form
            digit = max(0, (LETTERS if base == 26 else DIGITS if base == 10 else c).find(c))
            value, size = value * base + digit, size * base
        moved = self.other(value, size, f"{tweak}|{form}")
        out = []
        for c, shown, base in zip(reversed(lowered), reversed(head), reversed(bases)):
            moved, i = divmod(moved, base)
            new = LETTERS[i] if base == 26 else DIGITS[i] if base == 10 else c
            out.append(new.upper() if shown.isupper() else new)
        return "".join(reversed(out)) + dot + last

    def _secret(self, text: str, _) -> str:
        moved = self.moved(text.lower(), HEX, "secret")
        return moved.upper() if text.upper() == text else moved

    def _iban(self, text: str, _) -> str | None:
        bare = text.replace(" ", "")
        if not 15 <= len(bare) <= 34 or iban_rest(bare) != 1:
            return None
        country, rest = bare[:2], bare[4:]
        moved = "".join(self._by_class(rest, f"iban|{country}"))
        check = 98 - iban_rest(f"{country}00{moved}")
        return fill(text, f"{country}{check:02d}{moved}")

    def _by_class(self, text: str, tweak: str) -> str:
        digits = [i for i, c in enumerate(text) if c in DIGITS]
        letters = [i for i, c in enumerate(text) if c not in DIGITS]
        out = list(text)
        for places, alphabet in ((digits, DIGITS), (letters, LETTERS.upper())):
            if places:
                for i, c in zip(places, self.moved("".join(text[i] for i in places), alphabet, f"{tweak}|{places}")):
                    out[i] = c
        return "".join(out)

    def _ip(self, text: str, match: re.Match) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or text != ".".join(map(str, parts)):
            return None
        if _VERSION.search(match.string, max(0, match.start() - _CUE_REACH), match.start()):
            return None
        moved = self.other(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, moved.to_bytes(4, "big")))

    def _date(self, text: str, match: re.Match) -> str | None:
        mark = match["s1"] or match["s2"]
        parts = text.split(mark)
        year_first = len(parts[0]) == 4
        year, a, b = (int(p) for p in (parts if year_first else (parts[2], parts[0], parts[1])))
        # month before day where the year is first or a slash divides, if that is a date
        for month_first in (True,) if year_first else (mark == "/", mark != "/"):
            month, day = (a, b) if month_first else (b, a)
            day_number = ordinal(year, month, day)
            if day_number is not None:
                rule = partial(readable, year_first=year_first, month_first=month_first, mark=mark)
                moved = dt.date.fromordinal(FIRST_DAY + self.other(day_number - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", rule))
                both = (moved.month, moved.day) if month_first else (moved.day, moved.month)
                padded = all(len(p) >= 2 for p in parts)
                shown = [f"{n:02d}" if padded else str(n) for n in both]
                return mark.join([f"{moved.year}", *shown] if year_first else [*shown, f"{moved.year}"])
        return None

    def _ssn(self, text: str, _) -> str | None:
        digits = text.replace("-", "")
        if not valid_ssn(digits):
            return None
        moved = self.other(int(digits), 10**9, "ssn", lambda v: valid_ssn(f"{v:09d}"))
        return fill(text, f"{moved:09d}")

    def _phone(self, text: str, match: re.Match) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 7 <= len(digits) <= 15:
            return None
        if match["national"]:
            if len(digits) > 11 or len(digits) == 7 and text[3] != "-":
                return None
            # what is no amount does not become one
            rule = (lambda v: v % 1000 > 0) if match["thirds"] else (lambda _: True)
            moved = self.other(int(digits[1:]), 10 ** (len(digits) - 1), f"phone|national|{digits[0]}|{len(digits)}", rule)
            return fill(text, f"{digits[0]}{moved:0{len(digits) - 1}d}")
        code = re.match(r"\+(\d{1,3})", text) if text.startswith("+") else None
        # a country's code stays where it stands apart; of digits that run on, the first does
        kept = code[1] if code and len(code[0]) < len(text) and not text[len(code[0])].isdigit() else digits[: bool(code)]
        return fill(text, kept + self.moved(digits[len(kept) :], DIGITS, f"phone|{kept}"))

    def _card(self, text: str, _) -> str | None:
        digits = re.sub(r"[ -]", "", text)
        return fill(text, self._checked(digits)) if luhn(digits) == 0 else None

    def _number(self, text: str, match: re.Match) -> str | None:
        if len(text) >= 12 and luhn(text) == 0:
            return self._checked(text)
        # a time, an order or a book has such numbers, too: only what is said to be personal is, and what is as long as
        # the number of a card, whether or not it was copied right
        personal = len(text) == _CARD_DIGITS
        return self.moved(text, DIGITS, "number") if personal or _CUE.search(match.string, max(0, match.start() - _CUE_REACH), match.start()) else None

    def _checked(self, digits: str) -> str:
        """A number that ends in its Luhn check digit."""
        head = self.moved(digits[:-1], DIGITS, "card")
        return head + str((10 - luhn(head + "0")) % 10)

    def replaced(self, text: str) -> tuple[str, list[Found]]:
        """The text with all values replaced, and what was found where."""
        if not _HINT.search(text):
            return text, []
        out, found, at = [], [], 0
        match = _ANY.search(text)
        while match:
            kind = next(k for k in FORMS if match[k] is not None)
            pseudonym = self.pseudonym(kind, match[0], match)
            if pseudonym is not None:
                out += text[at : match.start()], pseudonym
                found.append(Found(kind, match.start(), match.end(), pseudonym))
                at = match.end()
            # what is no valid value may still hold one that begins later
            match = _ANY.search(text, match.start() + 1 if pseudonym is None else at)
        return "".join([*out, text[at:]]), found


def fill(form: str, characters: str) -> str:
    """Letters and digits of ``form`` replaced in order."""
    following = iter(characters)
    return "".join(next(following) if c.isalnum() else c for c in form)


def luhn(digits: str) -> int:
    """0 for digits that end in their Luhn check digit."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def iban_rest(bare: str) -> int:
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97


def valid_ssn(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def ordinal(year: int, month: int, day: int) -> int | None:
    try:
        number = dt.date(year, month, day).toordinal()
    except ValueError:
        return None
    return number if FIRST_DAY <= number <= LAST_DAY else None


def readable(number: int, year_first: bool, month_first: bool, mark: str) -> bool:
    """Whether a date, written the same way, is read as itself again."""
    date = dt.date.fromordinal(FIRST_DAY + number)
    if year_first or date.month == date.day:
        return True
    prefers_month = mark == "/"
    return month_first == prefers_month if date.day <= 12 else True


def pseudonymised(docs: DataFrame, key: bytes, details: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; with ``details`` also ``found``, an array of
    (``kind``, ``start``, ``end``, ``pseudonym``), ``start`` and ``end`` in the original text.

    Texts are read whole; a null or empty text stays so and has an empty ``found``.  All rows stay, repeated
    ones too, and all columns, whatever their names; a column named ``found``, in any case of letters, is
    replaced if details are asked for.  An empty table gives no rows.  Nothing is shuffled.  Values of a kind
    that fail its check, as dates that do not exist, stay.
    """
    kinds = "array<struct<kind: string, start: int, end: int, pseudonym: string>>"

    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pseudonyms = kept(("pii", key), lambda: Pseudonyms(key))
        for batch in batches:
            rows = [(None, []) if t is None else pseudonyms.replaced(t) for t in batch]
            yield pd.DataFrame({"text": [t for t, _ in rows], "found": [[f._asdict() for f in found] for _, found in rows]}, dtype=object)

    done = docs.select(passed(docs, ("found",) if details else ()), F.pandas_udf(replaced, f"text string, found {kinds}")("text").alias("new"))
    names = [c for c in docs.columns if not (details and c.lower() == "found")]
    own = [F.col("new.text").alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in names]
    return done.select(*own, *(["new.found"] if details else []))
