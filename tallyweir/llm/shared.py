"""What several operators here share: tables in the shared folder, texts in slices, whole-array hashing."""

from __future__ import annotations

import re
import sys
import tempfile
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from typing import TypeVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

T = TypeVar("T")
SLICE_CHARS = 1_000_000
_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


#: Rows that Python workers get at once; documents may be long.
ROWS_AT_ONCE = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Let a session hand rows to Python workers in small batches, so that they need little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _local_folder()
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    """For sessions on one machine that name no shared folder, as in tests."""
    return tempfile.mkdtemp(prefix="run-")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write once and read back: cuts lineage, survives lost executors, and is not computed twice."""
    path = shared_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def passed(frame: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """All columns as one, ``row``, so that their names meet no others; ``but`` in any case of letters are left out."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in frame.columns if c.lower() not in but]).alias("row")


_kept: dict = {}


def kept(key: object, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept for the next tasks of this worker until another operator keeps something.

    Workers outlive tasks and serve all operators in turn, so only one of them may hold what it remembers.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def slices(texts: list[str], limit: int = SLICE_CHARS, most: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts, ``most`` of about ``limit`` characters, so that a task's memory does not follow its batch."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > limit or i - start == most):
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, one to one."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def unit(values: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from scrambled 64-bit values."""
    return (values >> np.uint64(11)).astype(np.float64) * 2.0**-53


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
    return out


_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[128:] = True
_IS_WORD[[*range(48, 58), *range(97, 123)]] = True


def _marks() -> str:
    """All combining marks as ranges of a character class; ``\\w`` has letters and digits, but not these."""
    codes = [c for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "M"]
    firsts = [c for c, before in zip(codes, [-1, *codes]) if c != before + 1]
    lasts = [c for c, after in zip(codes, [*codes[1:], -1]) if c != after - 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts))


#: Ranges of all combining marks, for character classes.
MARKS = _marks()
# Spaces, punctuation and symbols that are not ASCII.
_BETWEEN = re.compile(rf"[^\x00-\x7f\w{MARKS}]+")


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and how many each text has.

    A word is a run of letters, combining marks and digits, of any script, of the lower-cased text.  In scripts
    that are written without spaces it is what stands between two punctuation marks.  Words are found and hashed
    over the bytes of all texts at once.
    """
    lowered = [_separated(text.lower()).encode("utf-8", "replace") for text in texts]
    data = np.frombuffer(b"\n" + b"\n".join(lowered) + b"\n", dtype=np.uint8)
    inside = _IS_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_WORD_BASE, len(data)), out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * powers(_WORD_BASE_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(b) + 1 for b in lowered])
    counts = np.diff(np.searchsorted(starts, text_ends, side="right"), prepend=0)
    return hashes, counts


def _separated(text: str) -> str:
    """The text with a space for all that is no word character and not ASCII, as bytes tell only ASCII apart."""
    return text if text.isascii() else _BETWEEN.sub(" ", text)


def shingle_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, and how many each has.

    A text of fewer words, but at least one, has a single shingle of all of them.
    """
    words, counts = word_hashes(texts)
    starts = np.cumsum(counts) - counts
    n_out = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.repeat(starts, n_out) + ranges(n_out)
    length = np.repeat(np.minimum(counts, width), n_out)
    out = length.astype(np.uint64)
    padded = np.append(words, np.zeros(width, dtype=np.uint64))
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + np.where(i < length, padded[first + i], np.uint64(0)))
    return out, n_out


def ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... of every count, one after another."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
