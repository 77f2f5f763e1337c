"""Collocations against SQL from the definitions, and against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences

from tallyweir.llm import collocations as module
from tallyweir.llm.collocations import collocations, multikey_counts
from tallyweir.llm.queries import op13_collocations, oracle_statements


def by_definition(docs, least=30, share=80, top=2000):
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own.update(tuple(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    rows = []
    for lang, own in counts.items():
        phrases = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        dropped = {p[i : i + n] for p, f in phrases.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * f >= share * own[p[i : i + n]]}
        found = []
        for p, a in phrases.items():
            if p not in dropped:
                score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        rows += [(lang, i, p.decode(), -a, left, right, totals[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(rows)


def texts(rng, n=120):
    words = ["the", "The", "of", "a", "fox", "quick", "Zürich", "ÄB", "x\x01", "\x0e", "東京", "on", "big", "end"]
    out = []
    for _ in range(n):
        some = [rng.choice(words) for _ in range(rng.randrange(60))]
        if rng.random() < 0.5:
            some += ["quick", "brown", "fox", "jumps", "over"] * rng.randrange(3)
        if rng.random() < 0.3:
            some += ["haha"] * rng.randrange(12)
        marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! ", " ", "\x85"]
        out.append("".join(w + rng.choice(marks) for w in some))
    return out


ODD = [(None, "und too"), ("und", "und too"), ("en", None), ("en", ""), (None, None), ("", "one two"), ("d\ne", "one two"), ("en", "...!?\n\n"), ("en", "q " * 30_000)]


@pytest.mark.parametrize(("least", "share", "top", "filters"), [(3, 80, 2000, 2), (1, 100, 7, 1), (30, 50, 2000, 3)])
def test_any_texts(spark, least, share, top, filters, monkeypatch):
    monkeypatch.setattr(module, "FILTERS", filters)
    monkeypatch.setattr(module, "RANGE_ROWS", 50)
    monkeypatch.setattr(module, "SLICE_BYTES", 900)
    monkeypatch.setattr(module, "SUFFIX_ROWS", 300)
    rng = random.Random(least)
    docs = [(rng.choice(["en", "de", None]), t) for t in texts(rng)] + ODD * 2
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, n int, phrase string").repartition(3)
    assert sorted(tuple(r) for r in collocations(frame, least, share, top).collect()) == by_definition(docs, least, share, top)


def test_full_filters_only_lengthen_suffixes(spark, monkeypatch):
    monkeypatch.setattr(module, "frequent_bits", lambda docs, bitmaps, least: np.full(1 << 23, 255, dtype=np.uint8))
    docs = [("en", t) for t in texts(random.Random(9))]
    frame = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(tuple(r) for r in collocations(frame, 5).collect()) == by_definition(docs, 5)


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(module, "mixed", lambda values: values & np.uint64(1))
    data = [b"a b a ccc b", b"a b"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"]), pa.array(data)], ["lang", "text"])
    (words,) = module._words([batch])
    numbers, first = module._numbered(words)
    a, b, again, c, b2, other, other_b = numbers[words.at].tolist()
    assert a == again and b == b2 and len({a, b, c, other, other_b}) == 5
    assert [words.data[words.starts[i] : words.ends[i]].tobytes() for i in first] == [b"a", b"b", b"ccc", b"a", b"b"]


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_large_products_are_exact(spark):
    known = spark.createDataFrame([("en", "a b", 2, 2**61 + 1), ("en", "a", 1, 2**62 + 3), ("en", "b", 1, 2**61 + 1)], "lang string, phrase string, words int, n bigint")
    (row,) = module._scored(known).collect()
    assert row.score == 2_000_000 * (2**61 + 1) // (2**62 + 3 + 2**61 + 1)


def test_sort_counts_every_prefix():
    rng = np.random.default_rng(4)
    keys = rng.integers(-1, 4, (4, 5000))
    keys[0] = np.abs(keys[0])
    for d in range(1, 4):
        keys[d, keys[d - 1] < 0] = -1
    weights = rng.integers(1, 5, 5000)
    want = Counter()
    for row in range(5000):
        for d in range(4):
            if keys[d, row] >= 0:
                want[tuple(keys[: d + 1, row].tolist())] += int(weights[row])
    for least in (1, 200, 10**9):
        got = {tuple(keys[: d + 1, r].tolist()): w for r, d, w in zip(*(x.tolist() for x in multikey_counts(keys, weights, [17], least)))}
        kept = {tuple(keys[: d + 1, 17].tolist()) for d in range(4) if keys[d, 17] >= 0}
        assert got == {p: n for p, n in want.items() if n >= least or p in kept}


def test_the_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(op13_collocations(spark, sf_dir), connect(sf_dir), oracle_statements()["op13_collocations"]) is None
