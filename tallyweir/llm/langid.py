"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary.  Each language has a probability per piece, learned by
expectation maximisation; the probability of a word is the sum over all ways to put it together from
pieces, by the forward algorithm.  A text gets the language under which its words are most probable.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyweir.llm.shared import MARKS, kept, passed, slices

UNDETERMINED = "und"
PER_LANGUAGE = 1000
ROUNDS = 3
KNOWN_CHUNKS = 400_000
#: Characters of remembered chunks at most, as chunks may be long.
KNOWN_CHARS = 16_000_000
#: Words up to here are summed side by side, longer ones one by one; training takes the latter in parts of this length.
SIDE_BY_SIDE = 1024
# Added to the expected count of every piece, and the probability of a character that no piece covers.
PIECE_PRIOR = 0.01
UNKNOWN_CHARACTER = 1e-9
WORD_START = "▁"
# A word begins with a letter and goes on with letters and combining marks.
_WORD = re.compile(rf"[^\W\d_](?:[^\W\d_]|[{MARKS}])*")
_ASCII_WORD = re.compile("[a-z]+")
# Words times positions that are summed side by side, and positions after which sums are scaled.
_CELLS = 1 << 17
_SCALED = 32


class Model(NamedTuple):
    """``probabilities[piece, language]``; the row after the last piece is for characters without one."""

    vocabulary: str
    languages: list[str]
    probabilities: np.ndarray


class Lattice(NamedTuple):
    """All pieces that fit in the words: which word, where from and to, which piece, in the order of the ends."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    ends: np.ndarray


class Pieces(NamedTuple):
    """Numbers of the pieces, an automaton that finds them, and the characters that are pieces."""

    numbers: dict[str, int]
    matches: object
    single: frozenset[str]


@lru_cache(maxsize=2)
def pieces_of(vocabulary: str) -> Pieces:
    """The pieces of lower-case letters and combining marks in a vocabulary file."""
    import ahocorasick
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    numbers: dict[str, int] = {}
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        letters = piece.removeprefix(WORD_START)
        plain = not letters or letters == letters.lower() and all(c.isalpha() or unicodedata.category(c)[0] == "M" for c in letters)
        if not processor.is_control(i) and not processor.is_byte(i) and piece and plain:
            numbers.setdefault(piece, len(numbers))
    matches = ahocorasick.Automaton()
    for piece, i in numbers.items():
        matches.add_word(piece, (len(piece), i))
    matches.make_automaton()
    return Pieces(numbers, matches, frozenset(p for p in numbers if len(p) == 1))


def words_of(text: str) -> list[str]:
    """Runs of letters and combining marks of the lower-cased text, of any length, each beginning with a letter."""
    lowered = text.lower()
    return (_ASCII_WORD if lowered.isascii() else _WORD).findall(lowered)


def lattice(words: list[str], vocabulary: str) -> Lattice:
    pieces = pieces_of(vocabulary)
    rows: list[int] = []
    for w, word in enumerate(words):
        word = WORD_START + word
        for end, (length, piece) in pieces.matches.iter(word):
            rows += (w, end + 1 - length, end + 1, piece)
        if not pieces.single.issuperset(word):
            for i, c in enumerate(word):
                if c not in pieces.single:
                    rows += (w, i, i + 1, len(pieces.numbers))
    arcs = np.array(rows, dtype=np.int64).reshape(-1, 4)
    arcs = arcs[np.lexsort((arcs[:, 0], arcs[:, 2]))]
    most = int(arcs[-1, 2]) if len(arcs) else 0
    return Lattice(*arcs.T, np.searchsorted(arcs[:, 2], np.arange(1, most + 2)))


def forward(own: Lattice, n_words: int, probabilities: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``[word, position, language]``: the probability of all segmentations up to the position, scaled, and the logarithm of the scale."""
    alpha = np.zeros((n_words, len(own.ends), probabilities.shape[1]))
    scale = np.zeros_like(alpha)
    alpha[:, 0] = 1
    for e in range(1, len(own.ends)):
        part = slice(own.ends[e - 1], own.ends[e])
        word, start = own.word[part], own.start[part]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        values = alpha[word, start] * probabilities[own.piece[part]]
        if e <= _SCALED:
            alpha[word[first], e] = np.add.reduceat(values, first)
            continue
        before = scale[word, e - 1]
        sums = np.add.reduceat(values * np.exp(scale[word, start] - before), first)
        alpha[word[first], e], scale[word[first], e] = 1.0, before[first] + np.log(sums)
    return alpha, scale


def backward(own: Lattice, whole: np.ndarray, probabilities: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the position to the end of the word, which is at ``whole``."""
    beta = np.zeros((len(whole), len(own.ends), probabilities.shape[1]))
    scale = np.zeros_like(beta)
    beta[np.arange(len(whole)), whole] = 1
    back = np.lexsort((own.word, own.start))
    starts = own.start[back]
    for i in range(len(own.ends) - 2, -1, -1):
        part = back[np.searchsorted(starts, i) : np.searchsorted(starts, i + 1)]
        word, end = own.word[part], own.end[part]
        if not len(word):
            continue
        first = np.flatnonzero(np.diff(word, prepend=-1))
        after = scale[word, i + 1]
        sums = np.add.reduceat(beta[word, end] * probabilities[own.piece[part]] * np.exp(scale[word, end] - after), first)
        beta[word[first], i], scale[word[first], i] = 1.0, after[first] + np.log(sums)
    return beta, scale


def _alike(words: list[str]) -> Iterator[list[int]]:
    """Places of words of similar length, no more than are summed side by side."""
    part: list[int] = []
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        if part and (len(part) + 1) * (len(words[i]) + 2) > _CELLS:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def log_probabilities(words: list[str], model: Model) -> np.ndarray:
    """``[word, language]``, each word summed over all its segmentations."""
    out = np.empty((len(words), len(model.languages)))
    short = [i for i, w in enumerate(words) if len(w) <= SIDE_BY_SIDE]
    for i in set(range(len(words))).difference(short):
        out[i] = _one_long(words[i], model)
    for places in _alike([words[i] for i in short]):
        part = [short[i] for i in places]
        some = [words[i] for i in part]
        alpha, scale = forward(lattice(some, model.vocabulary), len(some), model.probabilities)
        at = np.arange(len(some)), [len(w) + 1 for w in some]
        out[part] = np.log(alpha[at]) + scale[at]
    return out


def _one_long(word: str, model: Model) -> np.ndarray:
    """The same for one word of any length, in memory of the longest piece."""
    pieces = pieces_of(model.vocabulary)
    word = WORD_START + word
    longest = max(map(len, pieces.numbers))
    ring = np.zeros((longest + 1, len(model.languages)))
    ring[0], scale, at = 1.0, np.zeros(len(model.languages)), 0
    unknown = model.probabilities[len(pieces.numbers)]

    def close(end: int) -> None:
        # all pieces that end here have been added
        nonlocal ring, scale
        if word[end - 1] not in pieces.single:
            ring[end % len(ring)] += ring[(end - 1) % len(ring)] * unknown
        if end % 8 == 0:
            norm = ring[end % len(ring)].copy()
            ring /= norm
            scale += np.log(norm)
        ring[(end + 1) % len(ring)] = 0.0

    ring[1] = 0.0
    for last, (length, piece) in pieces.matches.iter(word):
        while at < last:
            at += 1
            close(at)
        ring[(last + 1) % len(ring)] += ring[(last + 1 - length) % len(ring)] * model.probabilities[piece]
    while at < len(word):
        at += 1
        close(at)
    return np.log(ring[len(word) % len(ring)]) + scale


def expected_pieces(words: list[str], counts: np.ndarray, model: Model) -> np.ndarray:
    """How often every piece is expected, per language, in words that were seen ``counts[word, language]`` times."""
    out = np.zeros_like(model.probabilities)
    logs = np.log(model.probabilities)
    for part in _alike(words):
        some = [words[i] for i in part]
        own = lattice(some, model.vocabulary)
        whole = np.array([len(w) + 1 for w in some])
        at = np.arange(len(some)), whole
        alpha, a_scale = forward(own, len(some), model.probabilities)
        beta, b_scale = backward(own, whole, model.probabilities)
        with np.errstate(divide="ignore"):
            total = np.log(alpha[at]) + a_scale[at]
            before = np.log(alpha[own.word, own.start]) + a_scale[own.word, own.start]
            after = np.log(beta[own.word, own.end]) + b_scale[own.word, own.end]
        share = np.exp(before + logs[own.piece] + after - total[own.word])
        np.add.at(out, own.piece, share * counts[part][own.word])
    return out


def held_out() -> Column:
    """Documents that are never learned from: those whose id's checksum is divisible by 5, or that have no id."""
    return F.coalesce(F.expr("crc32(string(doc_id)) % 5 = 0"), F.lit(True))


def fit(docs: DataFrame, vocabulary: str, per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Learn from about ``per_language`` documents of each language (``doc_id``, ``text``, ``lang``), chosen by a hash.

    Documents that are held out, without text or without language teach nothing.  The words of the chosen
    documents are counted and the expected pieces added up by Spark; only piece counts reach the driver.
    """
    labelled = docs.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).selectExpr("doc_id", "lang", "text")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    number = {lang: i for i, lang in enumerate(languages)}
    pieces = pieces_of(vocabulary).numbers
    model = Model(vocabulary, languages, np.full((len(pieces) + 1, len(languages)), 1 / len(pieces)))
    model.probabilities[-1] = UNKNOWN_CHARACTER
    if not languages:
        return model
    share = F.expr("pmod(xxhash64(doc_id), 1000000007) / 1000000007D")
    shares = F.create_map(*chain.from_iterable((F.lit(lang), F.lit(per_language / n)) for lang, n in sizes.items()))
    chosen = labelled.where(share < shares[F.col("lang")])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch["lang"], batch["text"]):
                counts.update((number[lang], word[i : i + SIDE_BY_SIDE]) for word in words_of(text) for i in range(0, len(word), SIDE_BY_SIDE))
            rows = [(lang, word, n) for (lang, word), n in counts.items()]
            yield pd.DataFrame(rows, columns=["lang", "word", "n"])

    words = (
        chosen.select("lang", "text")
        .mapInPandas(counted, "lang int, word string, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .cache()
    )
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(model)
        totals = words.mapInPandas(_expecting(shared), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counts = np.full((len(pieces), len(languages)), PIECE_PRIOR)
        for piece, lang, n in totals.collect():
            if piece < len(pieces):
                counts[piece, lang] += n
        model.probabilities[:-1] = counts / counts.sum(axis=0)
        shared.unpersist()
    words.unpersist()
    return model


def _expecting(shared):
    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        total = np.zeros_like(model.probabilities)
        for batch in batches:
            words, at = np.unique(batch["word"].to_numpy(dtype=object), return_inverse=True)
            counts = np.zeros((len(words), len(model.languages)))
            np.add.at(counts, (at, batch["lang"].to_numpy()), batch["n"].to_numpy())
            total += expected_pieces(list(words), counts, model)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

    return expected


class Scorer:
    """Predicts texts; remembers the scores of ``known`` chunks between white space at most."""

    def __init__(self, model: Model, known: int = KNOWN_CHUNKS):
        self.model, self.limit = model, known
        self._forget()

    def _forget(self) -> None:
        # the first row is for chunks without letters
        self.known: dict[str, int] = {"": 0}
        self.chars = 0
        self.scores = np.zeros((1, len(self.model.languages)))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        chunks = [text.lower().split() for text in texts]
        if len(self.known) > self.limit or self.chars > KNOWN_CHARS:
            self._forget()
        self._learn(set().union(*chunks).difference(self.known))
        return [self._best(np.array(list(map(self.known.__getitem__, own)), dtype=np.int64)) for own in chunks]

    def _learn(self, chunks: set[str]) -> None:
        words = {chunk: words_of(chunk) for chunk in chunks}
        self.chars += 2 * sum(map(len, words))
        new = list(set().union(*words.values()).difference(self.known))
        at = len(self.scores)
        self.known.update(zip(new, range(at, at + len(new))))
        added = [self.scores, log_probabilities(new, self.model)] if new else [self.scores]
        self.scores = np.concatenate(added)
        sums = []
        for chunk, own in words.items():
            if len(own) == 1:
                self.known[chunk] = self.known[own[0]]
            elif not own:
                self.known[chunk] = 0
            else:
                self.known[chunk] = len(self.scores) + len(sums)
                sums.append(self.scores[[self.known[w] for w in own]].sum(axis=0))
        if sums:
            self.scores = np.concatenate((self.scores, np.array(sums)))

    def _best(self, rows: np.ndarray) -> tuple[str, float]:
        if not rows.any() or not self.model.languages:
            return UNDETERMINED, 0.0
        total = self.scores[rows].sum(axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predicted(docs: DataFrame, model: Model, known: int = KNOWN_CHUNKS) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the probability of that language among the learned ones.

    Only ``text`` is looked at; it is read whole.  A text that is null or has no letter, or any text if no
    language was learned, is ``und`` with score 0; ties go to the first language by name.  All columns and
    rows stay; columns named ``lang_pred`` or ``score``, in any case of
    letters, are replaced.  Nothing is shuffled.  A worker remembers
    the scores of ``known`` chunks at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = ("langid", uuid.uuid4().hex)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = kept(key, lambda: Scorer(shared.value, known))
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            rows = chain.from_iterable(scorer.predict(texts[low:high]) for low, high in slices(texts))
            yield pd.DataFrame(list(rows), columns=["lang_pred", "score"])

    return docs.select(passed(docs, ("lang_pred", "score")), predict("text").alias("prediction")).select("row.*", "prediction.lang_pred", "prediction.score")


def identify(docs: DataFrame, vocabulary: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learn from the documents that are not held out and predict all of them."""
    return predicted(docs, fit(docs, vocabulary, per_language))
