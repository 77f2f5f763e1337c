"""The registered queries of this subpackage: each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyweir.llm.alignment import aligned_scores
from tallyweir.llm.bpe import encode_decode
from tallyweir.llm.collocations import collocations
from tallyweir.llm.forest import vector_groups
from tallyweir.llm.guesscost import digest, secrets
from tallyweir.llm import html
from tallyweir.llm.langid import held_out, identify
from tallyweir.llm.minhash import near_duplicates
from tallyweir.llm.neighbours import nearest
from tallyweir.llm.packing import pack
from tallyweir.llm.pii import pseudonymised
from tallyweir.llm.shared import table
from tallyweir.llm.tokencounts import token_counts
from tallyweir.llm.urlfilter import derived_captures, derived_changes, intervals, judged

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
# The queries run under a fixed key, so that results can be compared; a user passes a secret one.
PSEUDONYM_KEY = b"key of the registered queries"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID).selectExpr(
        "doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = judged(derived_captures(pages), intervals(derived_changes(pages)))
    return found.withColumn("fetched", found["fetched"].cast("string"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), PIECE_VOCABULARY)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), BYTE_TOKENIZER).selectExpr(
        "doc_id", "n_tokens", "sha2(ids, 256) AS ids_sha256", "sha2(decoded, 256) AS decoded_sha256"
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.fit(pages))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(docs, PSEUDONYM_KEY, details=True).selectExpr("doc_id", "text", "bigint(size(found)) AS n_found")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, PIECE_VOCABULARY).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_scores(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_VOCABULARY)


def op12_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(secrets(table(spark, sf_dir, "documents"), WORD_TOKENIZER))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_neighbours": op2_neighbours,
    "op3_url_filter": op3_url_filter,
    "op4_minhash": op4_minhash,
    "op5_token_counts": op5_token_counts,
    "op6_bpe": op6_bpe,
    "op7_html": op7_html,
    "op8_pii": op8_pii,
    "op9_langid": op9_langid,
    "op10_forest": op10_forest,
    "op11_alignment": op11_alignment,
    "op12_guess_cost": op12_guess_cost,
    "op13_collocations": op13_collocations,
}


_HOST = "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)?"

# Written from the definitions: each capture against every entry, as DuckDB sees the dated changes.
_URL_FILTER = f"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(coalesce((page_id * 7 % 366 + 366) % 366, 0) AS INTEGER) AS fetched,
         rtrim(lower(regexp_extract(url, '{_HOST}', 1)), '.') AS host,
         coalesce(nullif(regexp_extract(url, '{_PATH}', 1), ''), '/') AS path
  FROM pages
),
hosts AS (SELECT DISTINCT host AS pattern FROM captures WHERE host <> ''),
domains AS (SELECT DISTINCT regexp_extract(host, '([^.]*[.])?([^.]*[.])?[^.]*$') AS pattern FROM captures WHERE host <> ''),
folders AS (
  SELECT DISTINCT host || '/' || split_part(path, '/', 2) || '/' AS pattern
  FROM captures WHERE host <> '' AND regexp_matches(path, '^/[^/]+/.')
),
numbered AS (
  SELECT kind, pattern, CAST('0x' || substr(md5(pattern), 1, 7) AS BIGINT) AS n
  FROM (SELECT 'host' AS kind, pattern FROM hosts UNION ALL SELECT 'domain', pattern FROM domains UNION ALL SELECT 'path', pattern FROM folders)
),
rules(list, verdict, kind, divisor, plus, listed) AS (
  VALUES ('hosts', 'block', 'host', 3, 0, true), ('hosts', 'block', 'host', 6, 60, false), ('hosts', 'block', 'host', 12, 120, true),
         ('domains', 'block', 'domain', 5, 30, true), ('trusted', 'allow', 'host', 7, 90, true), ('folders', 'block', 'path', 4, 45, true)
),
changes AS (
  SELECT list, verdict, kind, pattern, DATE '2023-12-01' + CAST(n % 300 + plus AS INTEGER) AS day, listed
  FROM numbered JOIN rules USING (kind) WHERE n % divisor = 0
),
valid AS (
  SELECT *, lead(day) OVER (PARTITION BY list, verdict, kind, pattern ORDER BY day) AS until FROM changes
),
ranked AS (
  SELECT c.page_id, v.verdict, v.list, v.kind, v.pattern,
         row_number() OVER (PARTITION BY c.page_id ORDER BY v.verdict = 'allow' DESC,
           CASE v.kind WHEN 'host' THEN 3 WHEN 'path' THEN 2 ELSE 1 END DESC, length(v.pattern) DESC, v.list, v.pattern) AS place
  FROM captures c JOIN valid v ON v.listed AND v.day <= c.fetched AND (v.until IS NULL OR c.fetched < v.until)
   AND CASE v.kind WHEN 'host' THEN v.pattern = c.host WHEN 'domain' THEN c.host = v.pattern OR ends_with(c.host, '.' || v.pattern)
       ELSE c.host || c.path = v.pattern OR (ends_with(v.pattern, '/') AND starts_with(c.host || c.path, v.pattern)) END
)
SELECT c.page_id, c.url, CAST(c.fetched AS VARCHAR) AS fetched, coalesce(r.verdict, 'none') AS verdict, r.list, r.kind, r.pattern
FROM captures c LEFT JOIN ranked r ON r.page_id = c.page_id AND r.place = 1
"""


# Written from the definitions: every phrase is counted, nothing is abandoned.
_COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
),
pieces AS (SELECT lang, unnest(pieces) AS piece FROM texts),
split AS (SELECT lang, [w FOR w IN string_split_regex(piece, '[ \t]') IF w <> ''] AS words FROM pieces),
totals AS (SELECT lang, sum(len(words)) AS n FROM split GROUP BY lang),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split WHERE len(words) > 0),
counted AS (
  SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM places, (VALUES (1), (2), (3), (4)) AS sizes(size)
  WHERE i + size - 1 <= len(words)
  GROUP BY ALL HAVING count(*) >= 30
),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidates, (VALUES (1), (2), (3)) AS places(k) WHERE k < size
),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest
),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
),
inside AS (
  SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (VALUES (1), (2), (3)) AS firsts(i), (VALUES (2), (3)) AS parts(part)
  WHERE part < size AND i + part - 1 <= size
  GROUP BY ALL
),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, s.score
  FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE s.place = 1 AND (i.most IS NULL OR CAST(100 AS HUGEINT) * i.most < CAST(80 AS HUGEINT) * s.a)
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, CAST(t.n AS BIGINT) AS n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""


def oracle_statements() -> dict[str, str]:
    return {"op3_url_filter": _URL_FILTER, "op13_collocations": _COLLOCATIONS}
