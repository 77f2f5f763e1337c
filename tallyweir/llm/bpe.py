"""Byte-level BPE through a lexicon of frequent words.

The words of all texts are counted; the most frequent are encoded once and compiled, with their ids, into
a minimal acyclic transducer, which executors map into memory.  Other words are merged exactly.  A word is
a run without white space together with the single space before it, which the tokenizer's pattern never
looks beyond; what else there is of white space is cut so that this holds.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.automaton import Automaton, compiled
from tallyweir.llm.shared import kept, slices, stored

LEXICON_WORDS = 65_536
LONGEST_LEXICON_WORD = 64
KNOWN_WORDS = 600_000
_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
# The tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space between characters that are no white space: no match of the pattern spans the place before it.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> list[str]:
    """The words of a text; all but the first have lost the space before them."""
    return _CUT.split(text) if text else []


def regular(word: str) -> bool:
    """Whether cutting at every space has cut a word where ``cut`` does."""
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


class Merger:
    """Exact merges of words by the tokenizer, and exact decoding."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.special = [t["content"] for t in content["added_tokens"]]
        self.pattern = regex.compile(PATTERN)
        letters = byte_letters()
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(letters)})
        back = {letter: byte for byte, letter in enumerate(letters)}
        self.pieces = {i: bytes(back[c] for c in piece) for piece, i in content["model"]["vocab"].items()}
        self.pieces.update((t["id"], t["content"].encode("utf-8")) for t in content["added_tokens"])

    def ids(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        merge = self.tokenizer.model.tokenize
        return [t.id for token in self.pattern.findall(text) for t in merge(token.encode("utf-8").decode("latin-1").translate(self.letters))]


def byte_letters() -> list[str]:
    """The letter that stands for every byte in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, free = [], 256
    for byte in range(256):
        letters.append(chr(byte) if byte in printable else chr(free))
        free += byte not in printable
    return letters


class Encoder:
    """Encodes texts with the lexicon and, for other words, with a merger; remembers ``known`` words at most."""

    def __init__(self, path: str, lexicon: bytes, known: int = KNOWN_WORDS):
        self.merger = _merger(path)
        self.lexicon = Automaton.mapped(lexicon)
        self.known, self.limit = {}, known
        self.special = re.compile("|".join(map(re.escape, self.merger.special)) or "(?!)")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; special tokens in a text become their ids."""
        if len(self.known) > self.limit:
            self.known.clear()
        words = [text.split(" ") for text in texts]
        self._learn(set(chain.from_iterable(words)).difference(self.known))
        return [self._encoded(text, own) for text, own in zip(texts, words)]

    def _encoded(self, text: str, words: list[str]) -> bytes:
        if self.special.search(text):
            return _packed(self.merger.tokenizer.encode(text, add_special_tokens=False).ids)
        known = self.known.__getitem__
        if regular(words[0]):
            with contextlib.suppress(TypeError):  # words that are cut otherwise have no ids
                return _packed(self.merger.ids(words[0])) + b"".join(map(known, words[1:]))
        words = cut(text)
        self._learn(set(words[1:]).difference(self.known))
        ids = [known(w) if regular(w) else _packed(self.merger.ids(" " + w)) for w in words[1:]]
        return _packed(self.merger.ids(words[0])) + b"".join(ids) if words else b""

    def _learn(self, words: set[str]) -> None:
        new = list(words)
        ids, output = self.merger.ids, self.lexicon.output
        for word, place in zip(new, self.lexicon.places([(" " + w).encode("utf-8") for w in new]).tolist()):
            self.known[word] = output(place) if place >= 0 else _packed(ids(" " + word)) if regular(word) else None

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.merger.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def _merger(path: str) -> Merger:
    return Merger(path)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of the words of all texts that follow a single space, counted in the tasks before the shuffle."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(text.split(" ")[1:] if text else ())
                if len(counts) > 500_000:
                    yield _counts(counts)
                    counts = Counter()
        yield _counts(counts)

    return docs.select("text").mapInPandas(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(counts: Counter) -> pd.DataFrame:
    rows = [(word, n) for word, n in counts.items() if regular(word)]
    return pd.DataFrame(rows, columns=["word", "n"]).astype({"word": object, "n": "int64"})


def frequent_words(docs: DataFrame, size: int = LEXICON_WORDS, longest: int = LONGEST_LEXICON_WORD) -> list[str]:
    """The words of all texts, none over ``longest`` characters, that occur oftenest: as many as fit into
    ``size`` without telling apart words that occur equally often."""
    counts = stored(word_counts(docs).where(f"char_length(word) <= {longest}"), "words")
    first = counts.orderBy(F.desc("n")).limit(size + 1).collect()
    least = first[-1].n + 1 if len(first) > size else 1
    return [r.word for r in first if r.n >= least]


def lexicon_of(words: list[str], tokenizer: str) -> bytes:
    """The compiled transducer of words, each with the space before it."""
    merger = _merger(tokenizer)
    return compiled({(" " + w).encode("utf-8"): merger.ids(" " + w) for w in words})


def encode_decode(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> DataFrame:
    """Ids of every text of ``docs`` (``doc_id``, ``text``) and the text decoded from them.

    ``ids`` holds little-endian unsigned 32-bit integers.  A null text counts as empty and has no ids; a null
    or repeated ``doc_id`` is kept, every row for itself; other columns are ignored; an empty table gives no
    rows.  The lexicon, at most ``size`` words of bounded length, is the only thing that passes the driver.
    """
    spark = docs.sparkSession
    lexicon = spark.sparkContext.broadcast(lexicon_of(frequent_words(docs, size), tokenizer))

    key = ("bpe", uuid.uuid4().hex)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(key, lambda: Encoder(tokenizer, lexicon.value))
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for low, high in slices(texts):
                ids = encoder.encode(texts[low:high])
                columns = [len(i) // 4 for i in ids], ids, [encoder.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], *(pa.array(c, f.type) for c, f in zip(columns, list(_ENCODED)[1:]))], schema=_ENCODED)

    return docs.selectExpr("bigint(doc_id) AS doc_id", "text").mapInArrow(encoded, "doc_id bigint, n_tokens bigint, ids binary, decoded string")
