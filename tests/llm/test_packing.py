from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyweir.llm.packing import ChunkEncoder, pack, piece_lengths, write_buckets
from tallyweir.llm.queries import END_ID, WORD_TOKENIZER, op1_packing

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    "Hello,  World! it's\tfine",
    "",
    " \n ",
    "a\x1cb c\x1d d",
    "<|endoftext|> and <|startoftext|>x",
    "İstanbul ΣΑΣ Straße é ́x ﬁ １２３ 中文 😀👍🏽",
    "x" * 3000,
    "don't we'll I'd 12345 a_b __ --",
    "NBSP here and　there᠎x​y",
]


def library_ids(texts):
    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_chunks_give_the_ids_of_whole_texts():
    encoder = ChunkEncoder(WORD_TOKENIZER, known=3)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(TEXTS)] == library_ids(TEXTS)


def test_piece_lengths():
    assert piece_lengths(1, 8) == [1]
    assert piece_lengths(22, 8) == [8, 8, 4, 2]
    assert piece_lengths(4096, 4096) == [4096]
    for n in range(1, 200):
        assert sum(piece_lengths(n, 16)) == n


def test_every_id_is_in_one_piece(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "one two", "y"), (3, "again", "z"), (3, "again", "z"), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    got = pack(docs, WORD_TOKENIZER, END_ID, 64).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    want = sorted(ids + [END_ID] for ids in library_ids([r[1] or "" for r in rows]))
    whole = {}
    for r in sorted(got, key=lambda r: r.sequence_id):
        assert r.offset == 0 and r.bucket == r.length and r.length & (r.length - 1) == 0 and r.length <= 64
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        own = whole.setdefault(r.sequence_id if r.start == 0 else max(k for k in whole if k < r.sequence_id), [])
        assert len(own) == r.start
        own += ids
    assert sorted(whole.values()) == want
    write_buckets(pack(docs, WORD_TOKENIZER, END_ID, 64), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(got)


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id bigint, text string"), WORD_TOKENIZER, END_ID).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    ids = dict(zip(docs, library_ids(list(docs.values()))))
    got = op1_packing(spark, SF_DIR).collect()
    covered = dict.fromkeys(docs, 0)
    for r in got:
        own = [*ids[r.doc_id], END_ID]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        covered[r.doc_id] += r.length
    assert covered == {d: len(i) + 1 for d, i in ids.items()}
    assert public_tokenizers.path("word_bpe_49k.json") == WORD_TOKENIZER
