"""What all operators on documents have in common: ids beyond floats, clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyweir.llm.bpe import encode_decode
from tallyweir.llm.langid import fit, predicted
from tallyweir.llm.minhash import deduplicated, near_duplicates
from tallyweir.llm.packing import pack
from tallyweir.llm.pii import pseudonymised
from tallyweir.llm.queries import BYTE_TOKENIZER, END_ID, PIECE_VOCABULARY, WORD_TOKENIZER
from tallyweir.llm.urlfilter import intervals, judged

IDS = [2**53 + 1, 2**53 + 3, 2**63 - 1, -(2**63), None, 0]
TEXTS = [" ".join(f"{w}{c}" for c in "abcdefghi") for w in ("first", "second", "third", "fourth", "fifth", "sixth")]
CLASHING = ["row", "key", "_key", "d", "_d", "x", "y", "rows", "new", "prediction", "_prediction", "_replaced", "entry", "_url", "at", "own", "band", "node", "k1", "KEY", "Rows"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(zip(IDS, TEXTS, ["en"] * 6)), "doc_id bigint, text string, lang string").coalesce(1)


@pytest.fixture(scope="module")
def crowded(docs):
    """The documents with columns named as anything inside the operators, in several cases."""
    names = {n.lower(): n for n in CLASHING}
    return docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names.values())])


@pytest.mark.parametrize(
    "operator", [lambda d: pack(d, WORD_TOKENIZER, END_ID), lambda d: encode_decode(d, BYTE_TOKENIZER), near_duplicates, deduplicated], ids=["op1", "op4", "op6", "dedup"]
)
def test_ids_stay_exact_beside_a_null(docs, operator):
    assert {r.doc_id for r in operator(docs).collect()} == set(IDS)


def test_the_pipeline_keeps_all_different_texts(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(IDS)


def test_columns_of_any_name_pass(crowded):
    want = sorted(map(str, crowded.collect()))
    assert sorted(map(str, deduplicated(crowded).collect())) == want
    assert sorted(map(str, pseudonymised(crowded, b"k").collect())) == want
    assert pseudonymised(crowded.withColumn("Found", F.lit(1)), b"k", details=True).columns == [*crowded.columns, "found"]
    named = predicted(crowded.withColumns({"Score": F.lit("mine"), "LANG_PRED": F.lit("mine")}), fit(crowded, PIECE_VOCABULARY))
    assert named.columns == [*crowded.columns, "lang_pred", "score"] and named.count() == 6


def test_the_stages_keep_columns_of_any_name(spark, crowded):
    wide = crowded.withColumns({"_pred": F.lit(1), "_score": F.lit(2), "Lang_Pred": F.lit("mine"), "SCORE": F.lit(0.5)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, "")
        assert out.columns == wide.columns and sorted(map(str, out.collect())) == sorted(map(str, wide.collect()))


def test_captures_with_columns_of_any_name(spark):
    day = "DATE '2024-01-01'"
    valid = intervals(spark.sql(f"SELECT 'l' AS list, 'block' AS verdict, 'host' AS kind, 'a.b' AS pattern, {day} AS day, true AS listed"))
    names = [n for n in {n.lower(): n for n in [*CLASHING, "_fetched", "at_url", "own_url", "since", "host", "path"]}.values()]
    captures = spark.sql(f"SELECT 'http://a.b/' AS url, {day} AS fetched, {', '.join(f'{i} AS `{n}`' for i, n in enumerate(names))}, 'x' AS List, 1 AS VERDICT")
    (row,) = judged(captures, valid).collect()
    assert row.verdict == "block" and list(row.asDict()) == ["url", "fetched", *names, "verdict", "list", "kind", "pattern"]
