"""The corpus pipeline: each stage works on what the one before it kept.

Stages read and return tables with the columns of ``documents``; the last returns packed sequences.  Null or
empty texts, and texts without letters, leave in the first stage; what each stage does with ties, repeated
rows, nulls and further columns stands at its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyweir.llm.langid import UNDETERMINED, fit, predicted
from tallyweir.llm.minhash import deduplicated
from tallyweir.llm.packing import pack
from tallyweir.llm.pii import pseudonymised
from tallyweir.llm.queries import END_ID, PIECE_VOCABULARY, PSEUDONYM_KEY, WORD_TOKENIZER
from tallyweir.llm.shared import passed, small_batches, stored, table

#: What a worker may remember in one stage: it serves all stages in turn, and memory once taken is slow to come back.
KNOWN_CHUNKS = 60_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; ``lang`` stays as labelled, only the text decides."""
    small_batches(spark)
    whole = docs.select(passed(docs), "text")
    found = predicted(whole, fit(docs, PIECE_VOCABULARY), KNOWN_CHUNKS)
    return found.where(found["lang_pred"] != UNDETERMINED).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return deduplicated(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; ``n_chars`` is that of the new text."""
    small_batches(spark)
    out = pseudonymised(docs, PSEUDONYM_KEY)
    if "n_chars" in out.columns:
        out = out.selectExpr(*[f"CAST(char_length(text) AS {docs.schema['n_chars'].dataType.simpleString()}) AS n_chars" if c == "n_chars" else f"`{c}`" for c in out.columns])
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, each of one document."""
    small_batches(spark)
    return pack(docs, WORD_TOKENIZER, END_ID, known=KNOWN_CHUNKS)


STAGES: list[tuple[str, Stage]] = [("language_id", language_id), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing)]

# SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
