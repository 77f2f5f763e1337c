"""Alignment of two tokenizers: which ids of one stand where ids of the other stand, over the whole corpus.

Texts are cut at single spaces between other characters, which neither tokenizer looks across, so a group of tokens
never spans a cut and every distinct chunk is aligned once.  The pairs of ids that a document links become postings of
its block: for every pair compressed bitmaps of the block's documents, one per binary digit of the multiplicity.
Merged by OR and popcounted they give the documents that hold a pair; the counts go back to the postings, which
return the scores of their documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.bitmaps import BLOCK_DOCS, added_up, members, planes
from tallyweir.llm.bpe import PATTERN, byte_letters, cut
from tallyweir.llm.packing import Known
from tallyweir.llm.shared import kept, ranges, slices, stored

KNOWN_CHUNKS = 300_000
KNOWN_WORDS = 150_000
#: Characters of remembered chunks at most, as chunks may be long.
KNOWN_CHARS = 16_000_000
#: Postings that a block holds at most, about; a document is never divided.
BLOCK_POSTINGS = 3_000_000
#: Links of one group that are listed one by one; larger groups are multiplied out by distinct ids.
LISTED_LINKS = 4096
SPACE = "▁"


class _Bytes:
    """The byte-level tokenizer, by its merges alone."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.merge = Tokenizer.from_file(path).model.tokenize
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.find = regex.compile(PATTERN).findall
        letters = byte_letters()
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(letters)})
        self.sizes = np.zeros(1 + max(vocabulary.values()), dtype=np.int64)
        for piece, i in vocabulary.items():
            self.sizes[i] = len(piece)
        self.words = Known(self._word)

    def _word(self, word: str) -> list[int]:
        return [t.id for t in self.merge(word.encode("utf-8", "replace").decode("latin-1").translate(self.letters))]

    def ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks with the space before each; chunks share most of their words."""
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        look = self.words.__getitem__
        words = [self.find(" " + chunk) for chunk in chunks]
        return [look(own[0]) if len(own) == 1 else [*chain.from_iterable(map(look, own))] for own in words]


class _Pieces:
    """The SentencePiece tokenizer."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.processor.get_piece_size()
        if n > 1 << 16:
            raise ValueError("a vocabulary of more than 65,536 pieces")
        self.bytes = [self._bytes(i) for i in range(n)]
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)
        if any(SPACE in self.processor.id_to_piece(i).lstrip(SPACE) for i in range(n)):
            raise ValueError("pieces that go on after a space")

    def _bytes(self, i: int) -> bytes:
        if self.processor.is_byte(i):
            return bytes([int(self.processor.id_to_piece(i)[3:5], 16)])
        return self.processor.id_to_piece(i).replace(SPACE, " ").encode("utf-8")

    def ids(self, chunks: list[str]) -> list[list[int]]:
        return self.processor.encode(chunks, num_threads=1)


class Aligner:
    """Links of chunks, and what is remembered of them."""

    def __init__(self, byte_path: str, piece_path: str, known: int = KNOWN_CHUNKS):
        self.a, self.b, self.limit = _Bytes(byte_path), _Pieces(piece_path), known
        self.text_of = [[f"{i}{end}" for i in range(1 << 16)] for end in ",|;"]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.chars = 0
        #: Per chunk: whether its bytes agree, tokens of A and B, groups, links.
        self.facts = np.zeros((0, 5), dtype=np.int64)
        self.groups: list[str] = []
        self.sizes = np.zeros(0, dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.times = np.zeros(0, dtype=np.int64)
        self.used = np.zeros(0, dtype=np.int64)

    def forget_rare(self) -> None:
        """Forget the chunks that were not met again."""
        keep = self.used > 1
        if 2 * keep.sum() > self.limit or self.chars > KNOWN_CHARS:
            self.forget()
            return
        number = (np.cumsum(keep) - 1).tolist()
        self.numbers = {c: number[i] for (c, i), kept in zip(self.numbers.items(), keep.tolist()) if kept}
        self.chars = sum(map(len, self.numbers))
        self.groups = [g for g, kept in zip(self.groups, keep.tolist()) if kept]
        own = np.repeat(keep, self.sizes)
        self.facts, self.sizes, self.pairs, self.times = self.facts[keep], self.sizes[keep], self.pairs[own], self.times[own]
        self.used = np.zeros(len(self.groups), dtype=np.int64)

    def learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.numbers]
        if new:
            if len(self.numbers) + len(new) > self.limit or self.chars > KNOWN_CHARS:
                self.forget_rare()
                new = [c for c in chunks if c not in self.numbers]
            for low, high in slices(new, 200_000):
                self._learn(new[low:high])

    def _learn(self, new: list[str]) -> None:
        first = len(self.numbers)
        self.numbers.update(zip(new, range(first, first + len(new))))
        self.chars += sum(map(len, new))
        a, b = self.a.ids(new), self.b.ids(new)
        # pieces of unknown characters or of a mark that stands for a space have other bytes than the text
        same = [b"".join(map(self.b.bytes.__getitem__, own)) == (" " + c).encode("utf-8", "replace") for c, own in zip(new, b)]
        found = [(own if ok else [], other if ok else []) for own, other, ok in zip(a, b, same)]
        n_a, n_b = (np.array([len(f[i]) for f in found], dtype=np.int64) for i in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(f[i] for f in found), np.int64, int(n.sum())) for i, n in ((0, n_a), (1, n_b)))
        # chunks have the same bytes in both, so offsets may run on over all of them
        a_ends, b_ends = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        ends = np.intersect1d(a_ends, b_ends)
        a_group, b_group = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
        in_a, in_b = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
        a_chunk = np.repeat(np.arange(len(new)), n_a)
        chunk = np.zeros(len(ends), dtype=np.int64)
        chunk[a_group] = a_chunk
        facts = np.stack([np.array(same), n_a, n_b, np.bincount(chunk, minlength=len(new)), np.zeros(len(new), dtype=np.int64)], axis=1)
        np.add.at(facts[:, 4], chunk, in_a * in_b)
        self.facts = np.concatenate([self.facts, facts])
        self.used = np.append(self.used, np.zeros(len(new), dtype=np.int64))
        self.groups += self._texts(a, a_group, b, b_group, chunk, len(new))
        pairs, times, of = self._links(a, a_group, b, b_group, in_a, in_b)
        # the same pair within a chunk is one entry
        order = np.lexsort((pairs, chunk[of]))
        pairs, times, of = pairs[order], times[order], chunk[of][order]
        start = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (of[1:] != of[:-1]))) if len(pairs) else np.zeros(0, dtype=np.int64)
        self.sizes = np.append(self.sizes, np.bincount(of[start], minlength=len(new)))
        self.pairs = np.append(self.pairs, pairs[start])
        self.times = np.append(self.times, np.add.reduceat(times, start) if len(start) else times)

    def _links(self, a, a_group, b, b_group, in_a, in_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (A's id in the high 32 bits), how often, and their groups."""
        a_first, b_first = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        listed = in_a * in_b <= LISTED_LINKS
        mine = np.flatnonzero(listed[a_group])
        other = in_b[a_group[mine]]
        partner = np.repeat(b_first[a_group[mine]], other) + ranges(other)
        pairs, of = np.repeat(a[mine], other) << 32 | b[partner], np.repeat(a_group[mine], other)
        parts = [(pairs, np.ones(len(pairs), dtype=np.int64), of)]
        for g in np.flatnonzero(~listed):
            x, x_times = np.unique(a[a_first[g] : a_first[g] + in_a[g]], return_counts=True)
            y, y_times = np.unique(b[b_first[g] : b_first[g] + in_b[g]], return_counts=True)
            own = (x[:, None] << 32 | y[None, :]).ravel()
            parts.append((own, np.outer(x_times, y_times).ravel(), np.full(len(own), g)))
        return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))

    def _texts(self, a, a_group, b, b_group, chunk, n) -> list[str]:
        """The groups of every chunk as text, with an end after each."""
        comma, bar, semicolon = self.text_of
        a_last = np.append(a_group[1:] != a_group[:-1], True) if len(a) else np.zeros(0, dtype=bool)
        b_last = np.append(b_group[1:] != b_group[:-1], True) if len(b) else np.zeros(0, dtype=bool)
        words = [(bar if last else comma)[i] for i, last in zip(a.tolist(), a_last.tolist())]
        words += [(semicolon if last else comma)[i] for i, last in zip(b.tolist(), b_last.tolist())]
        order = np.argsort(np.append(2 * a_group, 2 * b_group + 1), kind="stable")
        of = chunk[np.append(a_group, b_group)[order]]
        ends = np.cumsum(np.bincount(of, minlength=n)).tolist()
        order = order.tolist()
        out, start = [], 0
        for end in ends:
            out.append("".join([words[i] for i in order[start:end]]))
            start = end
        return out


_NAMES = ["n_a", "n_b", "n_groups", "n_links"]
SCHEMA = (
    "block bigint, doc int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "a int, b int, docs int, planes array<binary>"
)
_ARROW = pa.schema(
    [("block", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64())] + [(n, pa.int64()) for n in _NAMES]
    + [("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int32()), ("planes", pa.list_(pa.binary()))]
)
# Blocks of one task start at the number of its partition times this.
_TASK_BLOCKS = 1 << 32


class _Block:
    """Collects the postings of at most ``BLOCK_DOCS`` documents."""

    def __init__(self):
        self.docs = self.size = 0
        self.keys, self.times = [], []

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(keys)
        self.times.append(times)
        self.size += len(keys)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        keys, times = added_up(np.concatenate(self.keys), np.concatenate(self.times)) if self.keys else (np.zeros(0, dtype=np.int64),) * 2
        bits = BLOCK_DOCS.bit_length() - 1
        pairs, docs, sets = planes(keys >> bits, keys & BLOCK_DOCS - 1, times)
        for low in range(0, len(pairs), 10_000):
            part = slice(low, low + 10_000)
            a = pairs[part] >> 16
            yield _batch(
                len(a), block=np.full(len(a), block), a=a.astype(np.int32), b=(pairs[part] & 0xFFFF).astype(np.int32),
                docs=docs[part].astype(np.int32), planes=sets[part],
            )


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if f.name not in columns else c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in _ARROW], schema=_ARROW
    )


def _aligned(aligner: Aligner, texts: list[str], first_doc: int) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Facts and hashes of texts, and their postings: pair and document in one key, and how often."""
    chunks = [cut(text) for text in texts]
    aligner.learn(set(chain.from_iterable(chunks)))
    counts = np.array([len(c) for c in chunks], dtype=np.int64)
    of = np.repeat(np.arange(len(texts)), counts)
    numbers = np.fromiter(map(aligner.numbers.__getitem__, chain.from_iterable(chunks)), np.int64, len(of))
    aligner.used += np.bincount(numbers, minlength=len(aligner.used))
    bad = np.zeros(len(texts), dtype=bool)
    bad[of[aligner.facts[numbers, 0] == 0]] = True
    good = ~bad[of]
    of, numbers = of[good], numbers[good]
    facts = np.zeros((len(texts), 4), dtype=np.int64)
    for i in range(4):
        np.add.at(facts[:, i], of, aligner.facts[numbers, i + 1])
    look, ends = aligner.groups.__getitem__, np.cumsum(np.bincount(of, minlength=len(texts))).tolist()
    listed, hashes, start = numbers.tolist(), [], 0
    for end in ends:
        hashes.append(hashlib.sha256("".join(map(look, listed[start:end])).encode()[:-1]).hexdigest() if end > start else "")
        start = end
    keys, times = added_up(of << 32 | numbers, np.ones(len(of), dtype=np.int64))
    doc, chunk = keys >> 32, keys & 0xFFFFFFFF
    sizes = aligner.sizes[chunk]
    at = np.repeat((np.cumsum(aligner.sizes) - aligner.sizes)[chunk], sizes) + ranges(sizes)
    pair = aligner.pairs[at] >> 32 << 16 | aligner.pairs[at] & 0xFFFF
    keys = pair * BLOCK_DOCS + first_doc + np.repeat(doc, sizes)
    return facts, hashes, *added_up(keys, np.repeat(times, sizes) * aligner.times[at])


def align(docs: DataFrame, byte_tokenizer: str, piece_model: str, known: int = KNOWN_CHUNKS) -> tuple[DataFrame, DataFrame]:
    """Documents with their blocks, and postings of pairs of ids, of ``docs`` (``doc_id``, ``text``).

    Documents: ``block``, ``doc``, ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``.  Postings:
    ``block``, ``a``, ``b``, ``docs`` (that hold the pair in this block) and ``planes``.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(("alignment", byte_tokenizer, piece_model, known), lambda: Aligner(byte_tokenizer, piece_model, known))
        number, block = TaskContext.get().partitionId() * _TASK_BLOCKS, _Block()
        for batch in batches:
            ids, texts = batch.column(0), ["" if t is None else t for t in batch.column(1).to_pylist()]
            for low, high in slices(texts, most=BLOCK_DOCS):
                if block.docs + high - low > BLOCK_DOCS or block.size > BLOCK_POSTINGS:
                    yield from block.rows(number)
                    number, block = number + 1, _Block()
                facts, hashes, *postings = _aligned(aligner, texts[low:high], block.docs)
                block.add(*postings)
                n = high - low
                yield _batch(
                    n, block=np.full(n, number), doc=np.arange(block.docs, block.docs + n, dtype=np.int32), doc_id=ids[low:high],
                    groups_sha256=pa.array(hashes, pa.string()), **{name: facts[:, i] for i, name in enumerate(_NAMES)},
                )
                block.docs += n
        yield from block.rows(number)

    rows = stored(docs.selectExpr("bigint(doc_id) AS doc_id", "text").mapInArrow(aligned, SCHEMA), "alignment")
    return (
        rows.where("a IS NULL").select("block", "doc", "doc_id", *_NAMES, "groups_sha256"),
        rows.where("a IS NOT NULL").select("block", "a", "b", "docs", "planes"),
    )


def pair_counts(postings: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (documents that hold the pair) and ``best`` (no other pair of ``a`` has more)."""
    counts = postings.groupBy("a", "b").agg(F.sum(F.col("docs").cast("bigint")).alias("count"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").selectExpr("a", "b", "count", "count = most AS best")


def aligned_scores(docs: DataFrame, byte_tokenizer: str, piece_model: str, known: int = KNOWN_CHUNKS) -> DataFrame:
    """One row per document of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is held by as many documents as any of its A id), ``count_sum`` (those documents,
    over all links), ``groups_sha256``.

    Tokenizer A reads a space and the text, B the text, to which it adds the space itself; special tokens in a text
    are plain text.  Places where both have a token's end divide the bytes into groups; all tokens of A in a group
    are linked with all of B in it.  A null or empty text, and one whose tokens do not give its bytes back, has no
    tokens, zeros and an empty hash.  A null or repeated ``doc_id`` is kept, every row is a document of its own;
    equal counts are all best; very long texts are read whole; an empty table gives no rows; other columns are
    ignored.
    """
    texts, postings = align(docs, byte_tokenizer, piece_model, known)
    found = postings.select("block", "a", "b", "planes").join(pair_counts(postings), ["a", "b"])
    scores = found.select("block", "planes", "count", "best").groupBy("block").applyInArrow(_scores, "block bigint, doc int, n_best bigint, count_sum bigint")
    return texts.join(scores, ["block", "doc"], "left").selectExpr(
        "doc_id", *_NAMES, "coalesce(n_best, 0L) AS n_best", "coalesce(count_sum, 0L) AS count_sum", "groups_sha256"
    )


def _scores(group: pa.Table) -> pa.Table:
    """The scores that a block's postings return to its documents."""
    group = group.combine_chunks()
    lists = group["planes"].chunk(0) if group["planes"].num_chunks else group["planes"].combine_chunks()
    digits = np.diff(lists.offsets.to_numpy().astype(np.int64))
    row = np.repeat(np.arange(len(lists)), digits)
    container, doc = members(lists.flatten())
    of, times = row[container], np.int64(1) << ranges(digits)[container]
    count, best = group["count"].to_numpy()[of], group["best"].to_numpy(zero_copy_only=False)[of]
    n_best, count_sum = np.zeros(BLOCK_DOCS, dtype=np.int64), np.zeros(BLOCK_DOCS, dtype=np.int64)
    np.add.at(n_best, doc[best], times[best])
    np.add.at(count_sum, doc, times * count)
    held = np.unique(doc)
    return pa.table(
        {"block": np.full(len(held), group["block"][0].as_py()), "doc": held.astype(np.int32), "n_best": n_best[held], "count_sum": count_sum[held]}
    )
