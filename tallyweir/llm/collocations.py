"""Collocations: phrases of two to four words that occur together more often than their parts.

Every word of a piece starts a suffix of at most four words.  The tasks add up equal suffixes, a range partitioning
routes them over the cluster by their leading words, and within each range a multikey three-way quicksort of pointers
to them goes down to the last word: the size of an equal partition is the count of a phrase, and partitions that
cannot hold a frequent phrase are abandoned.  Only the phrases at the two ends of a range may go on in the next one;
these are added up.

Suffixes are cut short before words and pairs that are infrequent in all texts.  That is known from counts by places
of hashes, pairs being counted of what the words left, and kept as bitmaps of fixed size: when places agree by chance
some suffixes are longer than needed, never shorter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.shared import mixed, powers, ranges, stored

LONGEST = 4
LEAST = 30
SHARE = 80
TOP = 2000
#: Bits of each bitmap of frequent hashes; a larger corpus makes them fuller, not larger.
FILTER_BITS = 1 << 26
#: Lengths of phrases, from one word on, that suffixes are cut short by.
FILTERS = 2
#: Bits that are counted together.
PART_BITS = 1 << 15
#: Suffixes that a task adds up before it writes them.
SUFFIX_ROWS = 2_000_000
#: Suffixes that one range holds at most, about.
RANGE_ROWS = 500_000
#: Bytes of texts that are looked at together.
SLICE_BYTES = 2_000_000
NO_LANG = "und"
# Ends every word of a suffix; cannot be in a word.
_END = "\n"
# Lower-cases A-Z, makes tabs spaces and all ends of pieces line feeds.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_SALT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


class _Words(NamedTuple):
    """The words of some texts: hashes by position, 0 where a piece ends, and each word's position, bytes and language."""

    hashes: np.ndarray
    at: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    lang: np.ndarray
    langs: list[str]


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts in pieces of bytes, cut only between pieces, about ``SLICE_BYTES`` at once, with their languages."""
    texts, langs, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data, start = (text or b"").translate(_BYTES), 0
            while start < len(data):
                room, end = SLICE_BYTES - size, len(data)
                if start + room < len(data):
                    cut = data.rfind(b"\n", start, start + room)
                    # a text that does not fit goes on in the next slice; a piece alone may be longer than that
                    end = cut + 1 if cut >= 0 else start if texts else (data.find(b"\n", start) + 1 or len(data))
                if end > start:
                    texts.append(data[start:end])
                    langs.append(lang)
                    size += end - start
                start = end
                if size >= SLICE_BYTES or start < len(data):
                    yield texts, langs
                    texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[_Words]:
    """The words of whole texts, found and hashed over the bytes of many texts at once."""
    power = inverse = np.zeros(0, dtype=np.uint64)
    for texts, names in _chunks(batches):
        data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8)
        if len(power) < len(data):
            power, inverse = powers(_BASE, len(data) * 5 // 4), powers(_BASE_INVERSE, len(data) * 5 // 4)
        inside = (data != 32) & (data != 10)
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        langs = list(dict.fromkeys(names))
        code = {lang: i for i, lang in enumerate(langs)}
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts)
        lang = np.array([code[n] for n in names], dtype=np.int64)[text]
        seeds = np.array([xxhash.xxh64_intdigest(n.encode("utf-8", "replace")) for n in langs], dtype=np.uint64)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
            own = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        own = np.maximum(mixed(own ^ seeds[lang]), np.uint64(1))
        line_ends = np.flatnonzero(data == 10)
        at = np.arange(len(starts)) + np.searchsorted(line_ends, starts)
        hashes = np.zeros(len(starts) + len(line_ends) + LONGEST, dtype=np.uint64)
        hashes[at] = own
        yield _Words(hashes, at, data, starts, ends, lang, langs)


def _numbered(words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words by position, 0 where a piece ends, equal exactly for equal words of a language, and the first
    word with each number."""
    _, first, number = np.unique(words.hashes[words.at], return_index=True, return_inverse=True)
    sizes, same = words.ends - words.starts, first[number]
    if (words.lang == words.lang[same]).all() and (sizes == sizes[same]).all():
        place = ranges(sizes)
        exact = (words.data[np.repeat(words.starts, sizes) + place] == words.data[np.repeat(words.starts[same], sizes) + place]).all()
    else:
        exact = False
    if not exact:
        # different words with one hash
        known: dict[tuple[int, bytes], int] = {}
        each = [known.setdefault((k, words.data[a:b].tobytes()), i) for i, (k, a, b) in enumerate(zip(words.lang.tolist(), words.starts, words.ends))]
        first, number = np.unique(each, return_inverse=True)
    out = np.zeros(len(words.hashes), dtype=np.int64)
    out[words.at] = number + 1
    return out, first


def _places(hashes: np.ndarray, at: np.ndarray, length: int, size: int) -> np.ndarray:
    """Places in a bitmap of ``size`` bits of the phrases of ``length`` words that begin at the given positions."""
    out = hashes[at]
    with np.errstate(over="ignore"):
        for i in range(1, length):
            out = mixed(out * _SALT + mixed(hashes[at + i] ^ _SALT))
    return (out & np.uint64(size - 1)).astype(np.int32)


def _frequent(hashes: np.ndarray, bitmaps: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each bitmap the positions where a phrase of its length may be frequent, and those of one word more.

    A phrase can only be frequent if its first and its last words are, all but one.
    """
    at, out = np.flatnonzero(hashes), []
    for length, bits in enumerate(bitmaps, 1):
        place = _places(hashes, at, length, 8 * len(bits))
        at = at[bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1]
        on = np.zeros(len(hashes), dtype=bool)
        on[at] = True
        out.append(on)
        at = at[on[at + 1]]
    return out, at


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr(f"coalesce(lang, '{NO_LANG}') AS lang", "CAST(text AS BINARY) AS text")


def frequent_bits(docs: DataFrame, bitmaps: list[Broadcast], least: int, size: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of ``size`` bits: places where phrases of one word more than there are bitmaps add up to ``least``.

    The tasks add up and send what they have by parts of the bitmap; every part is counted in an array of fixed size,
    whatever the number of rows.  The bitmap is all that reaches the driver.
    """
    length = len(bitmaps) + 1
    parts = max(1, size // PART_BITS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _words(batches):
            _, at = _frequent(words.hashes, [b.value for b in bitmaps])
            places, counts = np.unique(_places(words.hashes, at, length, size), return_counts=True)
            ends = np.searchsorted(places, np.arange(0, size + 1, size // parts))
            # what reaches the least number already needs no more
            columns = ((places & (size // parts - 1)).astype("<u2"), np.minimum(counts, least).astype("<u4" if least > 255 else "u1"))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), *(_cut(c, ends) for c in columns)], ["part", "places", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = sums.setdefault(part, np.zeros(size // parts, dtype=np.uint32))
                at = np.frombuffer(places, "<u2")
                own[at] = np.minimum(own[at] + np.frombuffer(counts, "<u4" if least > 255 else "u1"), np.uint32(least))
        bits = [np.packbits(own >= least, bitorder="little").tobytes() for own in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], ["part", "bits"])

    sent = _texts(docs).mapInArrow(counted, "part int, places binary, counts binary")
    tasks = max(32, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros(size // 8, dtype=np.uint8)
    for row in sent.repartition(tasks, "part").mapInArrow(added, "part int, bits binary").collect():
        own = np.frombuffer(row.bits, dtype=np.uint8)
        out[row.part * len(own) : (row.part + 1) * len(own)] = own
    return out


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the values between the ends."""
    offsets = pa.py_buffer((ends * values.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def suffixes(docs: DataFrame, bitmaps: list[Broadcast]) -> DataFrame:
    """``lang``, ``suffix`` (its words and empty places, each ended), ``n``, added up by task; an empty suffix counts all words.

    Suffixes have ``LONGEST`` words, fewer where they are cut short.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        # numbers of the task's frequent words, and its suffixes so far
        own: dict[tuple[str, bytes], int] = {("", b""): 0}
        kept, rows = [], 0
        for words in _words(batches):
            on, _ = _frequent(words.hashes, [b.value for b in bitmaps])
            at = np.flatnonzero(on[0])
            numbers, first = _numbered(words)
            columns, goes_on = [numbers[at]], np.ones(len(at), dtype=bool)
            for i in range(1, LONGEST):
                # the longest phrase that is filtered, or shorter ones at the beginning, must hold at each word
                goes_on = goes_on & on[min(i, len(on) - 1)][at + max(0, i - len(on) + 1)]
                columns.append(np.where(goes_on, numbers[at + i], 0))
            columns, counts = _added_up(columns)
            used = np.unique(np.concatenate(columns))
            used = used[used > 0]
            of, word = np.zeros(len(first) + 1, dtype=np.int64), first[used - 1]
            names = zip(words.lang[word].tolist(), words.starts[word].tolist(), words.ends[word].tolist())
            of[used] = [own.setdefault((words.langs[k], words.data[a:b].tobytes()), len(own)) for k, a, b in names]
            kept.append((*(of[c].astype(np.int32) for c in columns), counts))
            rows += len(counts)
            if rows > SUFFIX_ROWS:
                kept = [_merged(kept)]
                rows = len(kept[0][0])
                if 2 * rows > SUFFIX_ROWS:
                    yield from _written(kept[0], own)
                    own, kept, rows = {("", b""): 0}, [], 0
            for lang, n in zip(words.langs, np.bincount(words.lang, minlength=len(words.langs)).tolist()):
                totals[lang] = totals.get(lang, 0) + n
        if kept:
            yield from _written(_merged(kept), own)
        found = {lang: n for lang, n in totals.items() if n}
        yield _batch(pa.array(list(found), pa.string()), pa.array([""] * len(found), pa.string()), pa.array(list(found.values()), pa.int64()))

    return _texts(docs).mapInArrow(cut, "lang string, suffix string, n bigint")


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    columns = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
    return (*(out := _added_up(columns[:-1], columns[-1]))[0], out[1])


def _written(columns: tuple[np.ndarray, ...], words: dict[tuple[str, bytes], int]) -> Iterator[pa.RecordBatch]:
    """Suffixes as rows, their words by number."""
    texts = pa.array([word for _, word in words], pa.binary()).cast(pa.string(), safe=False)
    langs = pa.array([lang for lang, _ in words], pa.string())
    for low in range(0, len(columns[0]), 50_000):
        *own, counts = (pa.array(c[low : low + 50_000]) for c in columns)
        yield _batch(langs.take(own[0]), pc.binary_join_element_wise(*[texts.take(c) for c in own], "", _END), counts)


SUFFIXES = pa.schema([("lang", pa.string()), ("suffix", pa.string()), ("n", pa.int64())])


def _batch(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), schema=SUFFIXES)


def _added_up(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns and how often each occurs, or the sums of ``counts``."""
    code = columns[0].astype(np.int64)
    for column in columns[1:]:
        # codes and numbers are below the rows of a task's table, so both fit into 64 bits
        _, code = np.unique(code << np.int64(32) | column, return_inverse=True)
    _, first, code, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    if counts is not None:
        n = np.zeros(len(first), dtype=np.int64)
        np.add.at(n, code, counts)
    return [c[first] for c in columns], n.astype(np.int64)


def multikey_counts(keys: np.ndarray, weights: np.ndarray, open_rows: Iterable[int], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of row pointers: row, depth and weight of every equal partition that is kept.

    ``keys[d, row]`` is a row's key at depth ``d``; a negative key ends the row.  All partitions of a round are split
    at once, each by its own pivot, into the rows below, at and above it; equal ones go on at the next depth.
    Partitions whose weight is below ``least`` are abandoned, unless they hold one of ``open_rows``.
    """
    depths, n = keys.shape
    is_open = np.zeros(n, dtype=np.int64)
    is_open[list(open_rows)] = 1
    rows = np.arange(n)
    sizes, depth = np.array([n]), np.array([0])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(rows):
        starts = np.cumsum(sizes) - sizes
        three = np.sort(np.stack([keys[depth, rows[starts + p]] for p in (np.zeros_like(sizes), sizes // 2, sizes - 1)]), axis=0)
        of = np.repeat(np.arange(len(sizes)), sizes)
        key, pivot = keys[depth[of], rows], three[1][of]
        part = 3 * of + (key >= pivot) + (key > pivot)
        new_sizes = np.bincount(part, minlength=3 * len(sizes))
        new_starts = np.cumsum(new_sizes) - new_sizes
        sorted_rows = np.empty_like(rows)
        for side in range(3):
            own = np.flatnonzero(part % 3 == side)
            counts = new_sizes[side::3]
            sorted_rows[np.arange(len(own)) + np.repeat(new_starts[side::3] - (np.cumsum(counts) - counts), counts)] = rows[own]
        weight, opened = (_sums(v[sorted_rows], new_starts, new_sizes) for v in (weights, is_open))
        new_depth = np.repeat(depth, 3)
        equal = np.arange(len(new_sizes)) % 3 == 1
        stays = (new_sizes > 0) & ((weight >= least) | (opened > 0))
        first = sorted_rows[np.minimum(new_starts, len(rows) - 1)]
        stays &= ~(equal & (keys[new_depth, first] < 0))
        found = np.flatnonzero(stays & equal)
        out.append((first[found], new_depth[found], weight[found]))
        new_depth = new_depth + equal
        stays &= new_depth < depths
        rows = sorted_rows[np.repeat(stays, new_sizes)]
        sizes, depth = new_sizes[stays], new_depth[stays]
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, dtype=np.int64) for i in range(3))


def _sums(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values))
    return sums[starts + sizes] - sums[starts]


def phrases(found: DataFrame, least: int) -> DataFrame:
    """``lang``, ``phrase``, ``words``, ``n`` of all phrases of at most ``LONGEST`` words that occur ``least`` times."""
    spark = found.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), found.count() // RANGE_ROWS + 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [b for b in batches if len(b)]
        if not some:
            return
        table = pa.Table.from_batches(some)
        langs, suffix = table["lang"].combine_chunks(), table["suffix"].combine_chunks()
        words = pc.list_flatten(pc.split_pattern(suffix, _END)).dictionary_encode()
        keys = words.indices.to_numpy().reshape(len(table), LONGEST + 1)[:, :LONGEST].T.astype(np.int64)
        keys[keys == words.dictionary.index("").as_py()] = -1
        lang_codes = langs.dictionary_encode()
        keys = np.concatenate([lang_codes.indices.to_numpy().astype(np.int64)[None], keys])
        row, depth, weight = multikey_counts(keys, table["n"].to_numpy(), _ends(lang_codes, suffix), least)
        row, depth, weight = row[depth > 0], depth[depth > 0], weight[depth > 0]
        for d in range(1, LONGEST + 1):
            at = row[depth == d]
            own = [words.dictionary.take(pa.array(keys[i, at])) for i in range(1, d + 1)]
            phrase = pc.binary_join_element_wise(*own, " ") if d > 1 else own[0]
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(at)), phrase, pa.array(np.full(len(at), d, dtype=np.int32)), pa.array(weight[depth == d])],
                ["lang", "phrase", "words", "n"],
            )

    ranged = found.repartitionByRange(ranges, "lang", "suffix")
    counts = ranged.mapInArrow(counted, "lang string, phrase string, words int, n bigint")
    return counts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(f"n >= {least}")


def _ends(langs: pa.DictionaryArray, suffix: pa.Array) -> list[int]:
    """The rows that come first and last in the order of the range partitioning, by bytes."""
    data = suffix.cast(pa.binary())
    names = [name.encode("utf-8", "replace") for name in langs.dictionary.to_pylist()]
    codes = langs.indices.to_numpy()
    out = []
    for pick, end in ((min, "min"), (max, "max")):
        rows = np.flatnonzero(codes == names.index(pick(names)))
        own = data.take(pa.array(rows))
        out.append(int(rows[pc.index(own, pc.min_max(own)[end]).as_py()]))
    return out


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The ``top`` collocations of every language of ``docs`` (``lang``, ``text``).

    Words are what stands between spaces and tabs within a piece, pieces what stands between ``.,;:!?`` and line
    ends; A-Z are lower-cased.  A phrase of 2 to ``LONGEST`` words that occurs ``a`` >= ``least`` times scores
    floor(2000000 a / (l + r)), where ``l`` and ``r`` count the two parts of its lowest-scoring cut, the first of
    equal ones.  A phrase within a longer one that has ``share`` percent of its occurrences is left out.  Returns
    ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (all words of the language), ``score``.

    A null text has no words; a null language is ``und``, together with texts that are labelled so; repeated rows
    count as often as they occur; ties go by ``a``, then by the bytes of the phrase, so they cannot remain; an empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs, bitmaps = docs.select("lang", "text"), []
    for _ in range(FILTERS):
        bitmaps.append(spark.sparkContext.broadcast(frequent_bits(docs, bitmaps, least)))
    found = stored(suffixes(docs, bitmaps), "suffixes")
    known = stored(phrases(found.where("suffix <> ''"), least), "phrases")
    totals = found.where("suffix = ''").groupBy("lang").agg(F.sum("n").alias("n"))
    return _best(_without_parts(_scored(known), known, share), top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _scored(known: DataFrame) -> DataFrame:
    cuts = known.where("words > 1").selectExpr("lang", "phrase", "n AS a", "words", "explode(sequence(1, words - 1)) AS k")
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - words) AS rest")
    parts = known.selectExpr("lang", "phrase AS part", "n")
    scored = (
        cuts.join(parts.toDF("lang", "head", "l"), ["lang", "head"])
        .join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
        .selectExpr(
            "lang", "phrase", "a",
            "struct((DECIMAL(2000000) * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0))) AS score, k, l, r) AS cut",
        )
    )
    return scored.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")).selectExpr("lang", "phrase", "a", "cut.l AS l", "cut.r AS r", "cut.score AS score")


def _without_parts(scored: DataFrame, known: DataFrame, share: int) -> DataFrame:
    places = [(first, length) for length in range(2, LONGEST) for first in range(1, LONGEST - length + 2)]
    inside = [f"IF(words > {length} AND words >= {first + length - 1}, array_join(slice(all_words, {first}, {length}), ' '), NULL)" for first, length in places]
    longer = known.where("words > 2").selectExpr("lang", "words", "n", "split(phrase, ' ') AS all_words")
    within = longer.selectExpr("lang", "n", f"explode(array({', '.join(inside)})) AS phrase").where("phrase IS NOT NULL")
    most = within.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    return scored.join(most, ["lang", "phrase"], "left").where(
        f"most IS NULL OR 100 * CAST(most AS DECIMAL(20, 0)) < {share} * CAST(a AS DECIMAL(20, 0))"
    )


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language, chosen among parts of it before they meet."""
    order = "score DESC, a DESC, phrase"
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for part in (f"pmod(hash(phrase), {parts})", f"pmod(hash(phrase), {min(parts, 8)})", "0"):
        scored = scored.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, {part} ORDER BY {order})")).where(f"rank <= {top}")
    return scored.withColumn("rank", F.col("rank").cast("bigint"))
