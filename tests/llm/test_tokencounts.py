from __future__ import annotations

import random
import re

from tokenizers import Tokenizer, models, pre_tokenizers

from tallyweir.llm.queries import PIECE_VOCABULARY, op5_token_counts
from tallyweir.llm.tokencounts import Counter, token_counts, vocabulary_of

SF_DIR = "/root/testdata/sf0.001"


def library(vocabulary):
    """The same vocabulary in the tokenizers library, words marked at their start."""
    unknown = next((i for i, (p, _) in enumerate(vocabulary) if p == "<unk>"), 0)
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")])
    return tokenizer


def test_ties_and_unknown_characters_equal_the_library():
    rng = random.Random(3)
    pieces = sorted({"".join(rng.choice("▁abc") for _ in range(rng.randint(1, 4))) for _ in range(60)})
    vocabulary = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", -9.0) for i in range(256)] + [(p, -float(rng.randint(1, 4))) for p in pieces]
    tokenizer, counter = library(vocabulary), Counter(vocabulary, known=5)
    texts = [" ".join("".join(rng.choice("abcdé中😀") for _ in range(rng.randint(1, 12))) for _ in range(6)) for _ in range(400)]
    for text in texts:
        assert counter.texts([text]) == [len(tokenizer.encode(text).ids)], text


def test_documents_equal_the_library(spark):
    tokenizer = library(vocabulary_of(PIECE_VOCABULARY))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r.n_tokens for r in op5_token_counts(spark, SF_DIR).collect()}
    assert got == {d.doc_id: len(tokenizer.encode(d.text).ids) for d in docs}


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \n", 5), (None, "the the", 5), (4, "the", 5), (4, "the", 5), (5, "x" * 50_000, 5)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in token_counts(frame, PIECE_VOCABULARY).collect())
    tokenizer = library(vocabulary_of(PIECE_VOCABULARY))
    want = sorted((i is None, i or 0, len(tokenizer.encode(t or "").ids) if re.search(r"\S", t or "") else 0) for i, t, _ in rows)
    assert got == want
    assert token_counts(frame.limit(0), PIECE_VOCABULARY).count() == 0
