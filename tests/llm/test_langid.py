from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from tallyweir.llm.langid import (
    PIECE_PRIOR,
    UNKNOWN_CHARACTER,
    WORD_START,
    Model,
    Scorer,
    expected_pieces,
    fit,
    held_out,
    identify,
    log_probabilities,
    pieces_of,
    predicted,
    words_of,
)
from tallyweir.llm.queries import PIECE_VOCABULARY, op9_langid


def segmentations(word):
    for cuts in itertools.product((False, True), repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        yield [word[a:b] for a, b in zip(at, at[1:])]


def some_model():
    pieces = pieces_of(PIECE_VOCABULARY).numbers
    p = np.random.default_rng(3).random((len(pieces) + 1, 2))
    p /= p.sum(axis=0)
    p[-1] = UNKNOWN_CHARACTER
    return Model(PIECE_VOCABULARY, ["x", "y"], p)


def test_forward_sums_all_segmentations():
    model, words = some_model(), ["the", "mañana", "x", "鿋b", "strasse"]
    counts = np.array([[1, 0], [2, 5], [0, 1], [1, 1], [3, 0]])
    want = [by_hand(w, model) for w in words]
    assert np.allclose(log_probabilities(words, model), np.log([t for t, _ in want]))
    assert np.allclose(expected_pieces(words, counts, model), sum(c * n for (_, c), n in zip(want, counts)))


def test_words_keep_marks_and_length():
    assert words_of("A" * 70) == ["a" * 70]
    assert words_of("हिन्दी में, café déjà 3x x3y") == ["हिन्दी", "में", "café", "déjà", "x", "x", "y"]
    assert words_of("ภาษาไทยไม่มีช่องว่าง العَرَبِيَّة ́ 漢字かな") == ["ภาษาไทยไม่มีช่องว่าง", "العَرَبِيَّة", "漢字かな"]


def plain_log(word, model):
    """All segmentations by logarithms, position by position."""
    pieces, word = pieces_of(PIECE_VOCABULARY).numbers, WORD_START + word
    longest, logs = max(map(len, pieces)), np.log(model.probabilities)
    best = [np.zeros(len(model.languages))]
    for end in range(1, len(word) + 1):
        parts = [best[start] + logs[pieces[word[start:end]]] for start in range(max(0, end - longest), end) if word[start:end] in pieces]
        if word[end - 1] not in pieces:
            parts.append(best[end - 1] + logs[len(pieces)])
        best.append(np.logaddexp.reduce(parts))
    return best[-1]


def test_long_words_are_summed_whole(monkeypatch):
    model, rng = some_model(), np.random.default_rng(5)
    words = ["".join(rng.choice(list("abthe鿋éक्षि漢"), n)) for n in (1, 31, 32, 33, 40, 200, 700, 1023, 1024, 1025, 3000)]
    assert np.allclose(log_probabilities(words, model), [plain_log(w, model) for w in words], rtol=1e-10)
    counts = np.array(rng.integers(0, 3, (5, 2)), dtype=float)
    counts[:, 0] += 1
    share = expected_pieces(words[:5], counts, model)
    monkeypatch.setattr("tallyweir.llm.langid._SCALED", 0)
    assert np.allclose(share, expected_pieces(words[:5], counts, model))
    # every character of a word lies in one expected piece
    sizes = np.array([len(p) for p in pieces_of(PIECE_VOCABULARY).numbers] + [1])
    assert np.allclose(sizes @ share, [(len(w) + 1) for w in words[:5]] @ counts)


def test_long_words_and_forgetting():
    model = some_model()
    texts = ["the the of", "x" * 5000, "", "12 _ 3", "of the", "The.of, (the)"]
    assert Scorer(model, known=1).predict(texts) == [Scorer(model).predict([t])[0] for t in texts]
    assert [p[0] for p in Scorer(model).predict(texts)][2:4] == ["und", "und"]


def fitted_by_hand(rows, rounds):
    """Expectation maximisation over all segmentations of all words of the learned documents."""
    pieces = pieces_of(PIECE_VOCABULARY).numbers
    learned = [(text, lang) for i, text, lang in rows if zlib.crc32(str(i).encode()) % 5]
    languages = sorted({lang for _, lang in learned})
    model = Model(PIECE_VOCABULARY, languages, np.full((len(pieces) + 1, len(languages)), 1 / len(pieces)))
    model.probabilities[-1] = UNKNOWN_CHARACTER
    for _ in range(rounds):
        counts = np.full((len(pieces), len(languages)), PIECE_PRIOR)
        for text, lang in learned:
            for word in text.lower().split():
                own = by_hand(word, model)[1][:-1, languages.index(lang)]
                counts[:, languages.index(lang)] += own
        model.probabilities[:-1] = counts / counts.sum(axis=0)
    return model


def by_hand(word, model):
    """Probability of every segmentation, and expected pieces."""
    pieces = pieces_of(PIECE_VOCABULARY).numbers
    k = len(model.languages)
    total, counts = np.zeros(k), np.zeros_like(model.probabilities)
    for parts in segmentations(WORD_START + word):
        numbers = [pieces.get(p, len(pieces) if len(p) == 1 else None) for p in parts]
        if None not in numbers:
            p = np.prod(model.probabilities[numbers], axis=0)
            total += p
            for i in numbers:
                counts[i] += p
    return total, counts / total


HINDI = ["यह एक घर है", "में हूँ और तुम", "वह घर में है", "हम और तुम एक हैं", "यह है और वह", "तुम घर में हो"]
MARATHI = ["हे एक घर आहे", "मी आणि तू", "तो घरात आहे", "आम्ही आणि तू", "हे आहे आणि ते", "तू घरात आहेस"]


def test_the_query_equals_brute_force(spark, tmp_path):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "hi") for t in HINDI] + [(t, "mr") for t in MARATHI])]
    rows += [(100 + i, t, None) for i, t in enumerate(["में घर", "आहे घर", "12 ! ?", "", "x"])]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    model = fitted_by_hand([r for r in rows if r[2]], 3)
    got = {r.doc_id: r for r in op9_langid(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        words = words_of(text)
        if not words:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        logs = sum(np.log(by_hand(w, model)[0]) for w in words)
        best = int(logs.argmax())
        assert got[i].lang_pred == model.languages[best]
        assert got[i].score == pytest.approx(1 / np.exp(logs - logs[best]).sum())
    assert {got[100].lang_pred, got[101].lang_pred} == {"hi", "mr"}


def test_rows(spark):
    rows = [(i, t, l, "kept") for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    odd = [(None, "the dog", None, "a"), (0, "the dog", "de", "b"), (0, "the dog", "de", "b"), (7, None, "en", "c"), (8, "1 2", "en", "d"), (9, "", None, "e"), (99, "DIE KATZE! " * 9000, None, "f")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score string")
    got = identify(docs, PIECE_VOCABULARY).collect()
    assert len(got) == len(rows) + len(odd) and set(got[0].asDict()) == {"doc_id", "text", "lang", "lang_pred", "score"}
    for r in got:
        text = (r.text or "").lower()
        assert r.lang_pred == ("en" if "the" in text else "de" if "katze" in text else "und")
        assert 0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und")
    assert identify(docs.limit(0), PIECE_VOCABULARY).count() == 0
    nothing_learned = predicted(docs, fit(docs.where("lang IS NULL"), PIECE_VOCABULARY))
    assert {r.lang_pred for r in nothing_learned.collect()} == {"und"}


def test_held_out_documents_teach_nothing(spark):
    rows = [(i, "wort" if zlib.crc32(str(i).encode()) % 5 else "zzzz", "de") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    pieces = pieces_of(PIECE_VOCABULARY).numbers
    p = fit(docs, PIECE_VOCABULARY).probabilities
    assert p[pieces["z"], 0] == pytest.approx(p[:-1].min()) and p[:-1].min() > 0 and PIECE_PRIOR > 0
    assert {r.doc_id: r.h for r in docs.select("doc_id", held_out().alias("h")).collect()} == {i: t == "zzzz" for i, t, _ in rows}


def test_accuracy_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op9_langid(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    own = [r for r in got if r.held_out]
    assert len(own) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in own) >= 0.99 * len(own)
