from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyweir.llm.components import components
from tallyweir.llm.minhash import SIMILARITY, dart_signatures, deduplicated, near_duplicates
from tallyweir.llm.queries import op4_minhash
from tallyweir.llm.shared import mixed, word_hashes


def shingles(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_force(texts):
    """Component numbers by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(a.total(), b.total()) >= SIMILARITY * max(a.total(), b.total()) and (a & b).total() >= SIMILARITY * (a | b).total():
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def family_texts(seed=5):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for size, most in ((3, 2), (40, 6), (2, 1), (25, 12), (6, 4)):
        base = [word() for _ in range(rng.randrange(80, 200))]
        texts += [" ".join(edited(base, rng.randrange(most), rng)) for _ in range(size)]
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(20, 90))) for _ in range(30)]
    texts += [texts[0]] * 20 + [texts[0].upper() + "!"] + [" ".join(word() for _ in range(50)) for _ in range(20)]
    refrain = " ".join(word() for _ in range(30))
    texts += [" ".join([refrain] * n + [word()]) for n in (1, 2, 5, 6, 7, 12)]
    texts += ["one two", "One, two.", "one two three", "", "...", "x " * 20000]
    return texts


def test_signatures_agree_as_often_as_weighted_sets_do():
    rng = np.random.default_rng(1)
    elements = mixed(np.arange(60, dtype=np.uint64))
    a, b = rng.random(60) * 3, rng.random(60) * 3
    a[:20], b[40:] = 0, 0
    both = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    k = 4096
    own = [np.flatnonzero(x) for x in (a, b)]
    got = dart_signatures(np.concatenate([elements[i] for i in own]), np.concatenate([a[own[0]], b[own[1]]]), np.array([len(i) for i in own]), k)
    assert abs((got[0] == got[1]).mean() - both) < 5 * np.sqrt(both * (1 - both) / k)
    alone = dart_signatures(elements[own[0]], a[own[0]], np.array([len(own[0])]), k)
    assert (alone[0] == got[0]).all() and len(np.unique(got[0])) > 1000


def test_small_and_empty_sets_have_full_signatures():
    got = dart_signatures(mixed(np.arange(1, 5, dtype=np.uint64)), np.ones(4), np.array([1, 0, 3]), 192)
    assert (got[0] != 0).all() and (got[1] == 0).all() and (got[2] != 0).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300), (400, 100), (500, 501), (7, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(1, 61)} | {200: 100, 400: 100, 501: 500}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_groups_equal_brute_force(spark, seed):
    texts = family_texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    want = brute_force(texts)
    got = {r.doc_id: (r.group_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {i: (g, i == g) for i, g in enumerate(want)}


def word_shingles(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def typographic_texts():
    rng = random.Random(7)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    texts = []
    for left, right, space, dash in (('"', '"', " ", " - "), ("«\u00a0", "\u00a0»", "\u00a0", "\u2009—\u2009"), ("„", "“", "\u202f", "…"), ("‘", "’", "\u3000", "–")):
        texts.append("".join(f"{left}{w}{right}{space}" if i % 7 == 0 else w + (dash if i % 5 == 0 else space) for i, w in enumerate(words)))
    clause = lambda: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(rng.randrange(6, 14)))
    for stop in ("，", "。", "、", "！"):
        clauses = [clause() for _ in range(300)]
        changed = list(clauses)
        changed[rng.randrange(300)] = clause()
        texts += [stop.join(clauses), stop.join(changed), "；".join(clauses), "？".join(edited(clauses, 60, rng))]
    return [*texts, "…", "«\u00a0»", "。，", "été à Genève… « où »", "Été — à Genève, (où)"]


def test_unicode_marks_and_spaces_part_words(spark):
    texts = typographic_texts()
    sets = [word_shingles(t) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= SIMILARITY * len(a | sets[j]):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    assert len(set(group)) < len(texts) - 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert {r.doc_id: r.group_id for r in near_duplicates(docs).collect()} == dict(enumerate(group))
    assert [r.doc_id for r in deduplicated(docs).orderBy("doc_id").collect()] == [i for i, g in enumerate(group) if i == g]


def test_words_of_any_script():
    counts = lambda *texts: word_hashes(list(texts))[1].tolist()
    # marks belong to words, whether or not they are composed with a letter
    assert counts("हिन्दी में", "e\u0301te\u0301 où", "a_b", "٣٤ x²", "\ud800 a", "𝒳y 🙂 z", "İstanbul’da") == [2, 2, 2, 2, 1, 2, 2]
    a, b = (word_hashes([t])[0].tolist() for t in ("Où\u00a0« est »…", "où est"))
    assert a == b


def test_odd_rows(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "other words here", "x"), (None, "a b c d e f", "y"),
            (None, "only here", "y"), (None, "only here", "y"), (None, "Only, here", "z"), (2, None, "y"), (3, "", None), (3, "", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, k1 string")
    got = sorted(map(str, ((r.doc_id, r.group_id, r.kept) for r in near_duplicates(docs).collect())))
    want = [(1, 1, True)] * 3 + [(None, 1, False)] + [(None, None, True)] * 3 + [(2, 2, True), (3, 3, True), (3, 3, True), (None, None, True)]
    assert got == sorted(map(str, want))
    kept = sorted(map(str, ((r.doc_id, r.text) for r in deduplicated(docs).collect())))
    words = [str((1, "a b c d e f")), str((1, "other words here")), str((2, None)), str((3, "")), str((3, "")), str((None, None))]
    only = [k for k in kept if k not in words]
    assert len(only) == 1 and only[0].lower().startswith("(none, 'only") and sorted(kept) == sorted(words + only)
    assert near_duplicates(docs.limit(0)).count() == 0 and deduplicated(docs.limit(0)).columns == docs.columns


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want = [docs[g].doc_id for g in brute_force([d.text for d in docs])]
    got = {r.doc_id: (r.group_id, r.kept) for r in op4_minhash(spark, sf_dir).collect()}
    assert got == {d.doc_id: (w, d.doc_id == w) for d, w in zip(docs, want)}
