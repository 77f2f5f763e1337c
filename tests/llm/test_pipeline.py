from __future__ import annotations

import numpy as np
from test_minhash import brute_force
from tokenizers import Tokenizer

import corpus_pipeline
from tallyweir.llm.pii import Pseudonyms
from tallyweir.llm.queries import END_ID, PSEUDONYM_KEY, WORD_TOKENIZER

SF_DIR = "/root/testdata/sf0.001"


def expected(docs):
    """Sequences as (doc_id, start, ids) by the definitions, one document at a time."""
    docs = [d for d in docs if any(c.isalpha() for c in d.text or "")]
    groups = brute_force([d.text for d in docs])
    pseudonyms, tokenizer = Pseudonyms(PSEUDONYM_KEY), Tokenizer.from_file(WORD_TOKENIZER)
    out = []
    for i, d in enumerate(docs):
        if groups[i] == i:
            ids = [*tokenizer.encode(pseudonyms.replaced(d.text)[0], add_special_tokens=False).ids, END_ID]
            start = 0
            while start < len(ids):
                length = min(4096, 1 << (len(ids) - start).bit_length() - 1)
                out.append((d.doc_id, start, np.array(ids[start : start + length], "<u4").tobytes()))
                start += length
    return sorted(out)


def test_run_equals_the_definitions(spark):
    docs = sorted(spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, bytes(r.ids)) for r in got) == expected(docs)
    assert len({r.sequence_id for r in got}) == len(got)


def test_stages_keep_columns_and_stand_odd_rows(spark):
    rows = [
        (1, "the same words in this one text", "en", "s", 3, "x", 0.5),
        (2, "The same words, in this one text!", "en", "s", 3, "x", 0.5),
        (2, "The same words, in this one text!", "en", "s", 3, "x", 0.5),
        (None, "Other words are here, mail a.b@example.com", None, None, None, None, None),
        (3, None, "en", "s", 0, "y", 0.1),
        (4, "", "en", "s", 0, "y", 0.1),
        (5, "123 456 !!", "en", "s", 0, "y", 0.1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string, score double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert sorted(out.dtypes) == sorted(docs.dtypes)
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    kept = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in docs.collect() if r.text and "words" in r.text]))
    kept = corpus_pipeline.near_dedup(spark, kept, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == {1, None} and kept.count() == 2
    done = {r.doc_id: r for r in corpus_pipeline.pii(spark, kept, SF_DIR).collect()}
    assert "a.b@example.com" not in done[None].text and len(done[None].text) == done[None].n_chars and done[1].text == rows[0][1]
    assert corpus_pipeline.packing(spark, kept, SF_DIR).count() > 2 and corpus_pipeline.packing(spark, docs.limit(0), SF_DIR).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "packing"]
