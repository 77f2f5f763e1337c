from __future__ import annotations

import hashlib
import random

import numpy as np
from tokenizers import Tokenizer

from tallyweir.llm.automaton import Automaton, compiled
from tallyweir.llm.bpe import Encoder, Merger, cut, encode_decode, frequent_words, lexicon_of, word_counts
from tallyweir.llm.queries import BYTE_TOKENIZER, op6_bpe

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    "Hello world, hello  world\n\n it's\tfine   ",
    "",
    " ",
    "\n",
    "  leading and trailing  ",
    " one two  three　 four\r\nfive \x1c six\x1d\x1e seven\x85 eight",
    "<|endoftext|> in <|endoftext|><|endoftext|> it",
    "aaaa" * 2000 + " ab" * 500,
    "İstanbul ΣΑΣ é ́x １２３ 中文 😀👍🏽� end",
    "I'LL i'll 'tis don't 3.14 a_b -- !!!",
]


def library():
    tokenizer = Tokenizer.from_file(BYTE_TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_automaton_knows_its_words_and_no_others():
    random.seed(1)
    words = {bytes(random.choice(b"abc") for _ in range(random.randint(1, 7))): [i, i + 1][: i % 3] for i in range(400)}
    automaton = Automaton.mapped(compiled(words))
    others = [bytes(random.choice(b"abcd") for _ in range(random.randint(0, 9))) for _ in range(1000)]
    asked = [*words, *others, b""]
    for word, place in zip(asked, automaton.places(asked)):
        assert (place >= 0) == (word in words)
        if place >= 0:
            assert np.frombuffer(automaton.output(place), "<u4").tolist() == words[word]
    # words that end alike share states
    assert len(automaton.keys) < sum(map(len, words)) / 2
    assert Automaton.mapped(compiled({})).places([b"a", b""]).tolist() == [-1, -1]


def test_merges_and_cuts_equal_the_library():
    tokenizer, merger = library(), Merger(BYTE_TOKENIZER)
    encoder = Encoder(BYTE_TOKENIZER, lexicon_of(["world,", "hello", "ab", "two"], BYTE_TOKENIZER), known=2)
    for text in TEXTS:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        if "<|" not in text:
            assert merger.ids(text) == want
            assert sum((merger.ids((" " if i else "") + w) for i, w in enumerate(cut(text))), []) == want
        ids = encoder.encode([text])[0]
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert encoder.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)


def test_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "x y", 2), (4, "x y", 2), (4, "x y", 2), (5, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    tokenizer = library()
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in encode_decode(docs, BYTE_TOKENIZER, 3).collect())
    want = []
    for doc_id, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id is None, doc_id, len(ids), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert encode_decode(docs.limit(0), BYTE_TOKENIZER).count() == 0


def test_frequent_words(spark):
    docs = spark.createDataFrame([("a b b c c",), ("z c b x",), (None,)], "text string")
    assert {r.word: r.n for r in word_counts(docs).collect()} == {"b": 3, "c": 3, "x": 1}
    assert sorted(frequent_words(docs, 2)) == ["b", "c"] and frequent_words(docs, 1) == []
    assert frequent_words(docs, 2, longest=0) == []


def test_query(spark):
    tokenizer = library()
    got = {r.doc_id: r for r in op6_bpe(spark, SF_DIR).collect()}
    for doc in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = tokenizer.encode(doc.text or "", add_special_tokens=False).ids
        row = got.pop(doc.doc_id)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not got
