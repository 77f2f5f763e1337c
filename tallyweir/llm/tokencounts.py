"""Token counts of a unigram tokenizer without making tokens.

An Aho-Corasick automaton of the vocabulary finds every piece that ends at each place of a word; dynamic
programming keeps the best score up to there and how many pieces it took.  Ties go to the longest last
piece, as the tokenizer decides them.  A character without a piece counts as its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.shared import kept, slices

KNOWN_WORDS = 600_000
WORD_START = "▁"
# What a character without a piece costs below the lowest score of the vocabulary, as in the tokenizer.
UNKNOWN_PENALTY = 10.0
_BYTE = re.compile(r"<0x[0-9A-F]{2}>")


def vocabulary_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, in the order of their ids."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(processor.id_to_piece(i), processor.get_score(i)) for i in range(processor.get_piece_size())]


class Counter:
    """Counts tokens of texts; remembers the counts of ``known`` words at most."""

    def __init__(self, vocabulary: list[tuple[str, float]], known: int = KNOWN_WORDS):
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.known, self.limit = {}, known

    def word(self, word: str) -> int:
        """Pieces in the best segmentation of a word, which has the mark of its start."""
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, piece in self.matches.iter(word):
            ends[end].append(piece)
        for end, pieces in enumerate(ends):
            top, pick, single = None, 0, False
            # in the order of their starts, the longest first; a later one must be better
            for length, score in sorted(pieces, reverse=True):
                start = end + 1 - length
                single |= length == 1
                total = best[start] + score
                if top is None or total > top:
                    top, pick = total, count[start] + 1
            if not single and (top is None or best[end] + self.unknown > top):
                top, pick = best[end] + self.unknown, count[end] + len(word[end].encode("utf-8"))
            best[end + 1], count[end + 1] = top, pick
        return count[n]

    def texts(self, texts: list[str]) -> list[int]:
        words = [text.split() for text in texts]
        if len(self.known) > self.limit:
            self.known.clear()
        new = set().union(*words).difference(self.known)
        self.known.update((w, self.word(WORD_START + w)) for w in new)
        look = self.known.__getitem__
        return [sum(map(look, own)) for own in words]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every whole text of ``docs`` (``doc_id``, ``text``) under a unigram vocabulary file.

    White space separates words, and the start of each is marked.  A null or empty text has no tokens; null
    and repeated ids are kept, every row for itself; other columns are ignored; an empty table gives no rows.
    Nothing is shuffled.
    """

    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = kept(("tokencounts", vocabulary), lambda: Counter(vocabulary_of(vocabulary)))
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            yield pd.Series([n for low, high in slices(texts) for n in counter.texts(texts[low:high])], dtype=np.int64)

    return docs.select(F.col("doc_id").cast("bigint"), F.pandas_udf(counted, "bigint")("text").alias("n_tokens"))
