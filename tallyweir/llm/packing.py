"""Packing by power-of-two decomposition.

A document of ``n`` tokens is cut into pieces whose lengths are the binary digits of ``n``, the largest
no longer than the sequence length, longest first.  Each piece is a sequence of its own, so no sequence
holds parts of two documents, none needs padding, and equal lengths share a bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyweir.llm.bpe import byte_letters
from tallyweir.llm.shared import kept, slices

MAX_LENGTH = 4096
KNOWN_CHUNKS = 900_000
# The tokenizer's pattern.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters that Python takes for white space and the tokenizer does not, and what may start a special token.
_APART = re.compile("[\x1c-\x1f]|<\\|")
# Sequence ids of one task start at the number of its partition times this.
_TASK_IDS = 1 << 40
_PIECES = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket")])


class ChunkEncoder:
    """Token ids of texts for a lower-casing tokenizer that drops white space.

    Its pieces never span white space, so a text is encoded chunk by chunk, and chunks and the words in them
    are remembered, ``known`` of them at most.  In chunks of plain Latin letters the words are found here and
    given to the tokenizer's merges alone; other chunks go through the whole tokenizer, and so do texts with
    special tokens or unusual separators.
    """

    def __init__(self, path: str, known: int = KNOWN_CHUNKS):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model.tokenize
        self.words = regex.compile(WORD_PATTERN)
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.known, self.limit = Known(self._chunk), known

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.limit:
            self.known.clear()
        look = self.known.__getitem__
        return [b"".join(map(look, text.split())) if not _APART.search(text) else self._whole(text) for text in texts]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        # Below this, letters are composed already and each has its own lower case.
        if max(chunk) >= "\u0180" or "\u0130" in chunk:
            return self._whole(chunk)
        lowered = chunk.lower()
        words = self.words.findall(lowered)
        if words != [chunk]:
            return b"".join(map(self.known.__getitem__, words))
        word = chunk if chunk.isascii() and chunk.isalpha() else chunk.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.merges(word)], dtype="<u4").tobytes()


class Known(dict):
    """Remembers what ``make`` gives for a key."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


def piece_lengths(n: int, longest: int) -> list[int]:
    """Powers of two that add up to ``n``, none over ``longest``, in falling order."""
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if n % longest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, end_id: int, max_length: int = MAX_LENGTH, known: int = KNOWN_CHUNKS) -> DataFrame:
    """Sequences of the texts of ``docs`` (``doc_id``, ``text``), one row per piece.

    ``start`` counts the document's ids before the piece, ``ids`` holds its ids as little-endian unsigned
    32-bit integers, ``doc_tokens`` the document's ids with the final ``end_id``, ``bucket`` the sequence's
    length.  ``max_length`` is a power of two.  A null or empty text is one piece with ``end_id`` alone; a
    null or repeated ``doc_id`` is kept, every row is packed for itself; other columns are ignored; an empty
    table gives no rows.  A worker remembers ``known`` chunks at most.  Nothing is shuffled: ids of sequences are numbered within the read partitions.
    """
    if max_length < 1 or max_length & max_length - 1:
        raise ValueError("max_length must be a power of two")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("packing", tokenizer, known), lambda: ChunkEncoder(tokenizer, known))
        end = np.array([end_id], dtype="<u4").tobytes()
        next_id = TaskContext.get().partitionId() * _TASK_IDS
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for low, high in slices(texts):
                rows = []
                for row, ids in enumerate(encoder.encode(texts[low:high]), low):
                    ids += end
                    n, start = len(ids) // 4, 0
                    for length in piece_lengths(n, max_length):
                        rows.append((row, start, length, ids[4 * start : 4 * (start + length)], n, next_id, 0, length))
                        start += length
                        next_id += 1
                row, *columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *(pa.array(c, f.type) for c, f in zip(columns, list(_PIECES)[1:]))], schema=_PIECES)

    return docs.selectExpr("bigint(doc_id) AS doc_id", "text").mapInArrow(
        packed,
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, bucket bigint",
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences so that each folder holds sequences of one length."""
    pieces.write.partitionBy("bucket").parquet(path)
