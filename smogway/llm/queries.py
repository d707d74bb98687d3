"""The registered queries of the operators in this package, over whole tables, and their SQL where it exists."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.llm import alignment, backoff, pivot_codes, quality, url_filter
from smogway.llm.exact_dedup import exact_groups
from smogway.llm.fingerprints import fingerprint_edits
from smogway.llm.lattice import encode, read_pieces
from smogway.llm.mixing import mix
from smogway.llm.simhash import near_duplicates
from smogway.llm.suffix_dedup import remove_repeated_bytes
from smogway.llm.windows import remove_repeated_windows
from smogway.llm.wordpiece import sentencepiece_pieces, token_counts

#: A SentencePiece model file; the vocabulary of the token counts and of the encoding.
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: A byte-level BPE file, aligned with the pieces.
BYTE_LEVEL = os.environ.get("BYTE_LEVEL_MODEL", "/opt/tokenizers/byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


@query
def op1_fingerprints(spark, d):
    return fingerprint_edits(documents(spark, d))


@query
def op2_suffix_dedup(spark, d):
    cut = remove_repeated_bytes(documents(spark, d))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


ORACLE["op2_suffix_dedup"] = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents
), blocks AS (
  SELECT doc_id, n_bytes, b, substr(h, 2 * b + 1, 898) AS part
  FROM (SELECT *, unnest(range(0, n_bytes, 400)) AS b FROM docs)
), bytes AS (
  SELECT doc_id, b + j AS i, CASE WHEN b + j + 49 <= n_bytes THEN md5_number(substr(part, 2 * j - 1, 100)) END AS seq
  FROM (SELECT *, unnest(range(1, least(400, n_bytes - b) + 1)) AS j FROM blocks)
), firsts AS (
  SELECT seq, min(doc_id) AS first_id FROM bytes WHERE seq IS NOT NULL GROUP BY seq
), flagged AS (
  SELECT b.doc_id, b.i, CASE WHEN f.first_id < b.doc_id THEN b.i END AS again
  FROM bytes b LEFT JOIN firsts f ON b.seq = f.seq
), covered AS (
  SELECT doc_id, i, coalesce(i - max(again) OVER (PARTITION BY doc_id ORDER BY i) < 50, false) AS gone FROM flagged
), runs AS (
  SELECT doc_id, gone, min(i) AS lo, count(*) AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, gone ORDER BY i) AS run FROM covered)
  GROUP BY doc_id, gone, run
), cut AS (
  SELECT doc_id, sum(n) FILTER (WHERE gone)::BIGINT AS n_removed, count(*) FILTER (WHERE gone) AS n_spans,
         string_agg(substr(h, 2 * lo - 1, 2 * n), '' ORDER BY lo) FILTER (WHERE NOT gone) AS kept
  FROM runs JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, d.n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs d LEFT JOIN cut USING (doc_id)
"""


@query
def op3_quality(spark, d):
    docs = documents(spark, d)
    return quality.score(docs, quality.fit(docs, spark.read.parquet(f"{d}/labels.parquet")))


@query
def op4_simhash(spark, d):
    return near_duplicates(documents(spark, d))


@query
def op5_url_filter(spark, d):
    return url_filter.judge(spark.read.parquet(f"{d}/pages.parquet"))


@query
def op6_sentencepiece(spark, d):
    pieces = read_pieces(PIECES)
    both = encode(documents(spark, d), pieces, decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_exact_dedup(spark, d):
    return exact_groups(documents(spark, d))


ORACLE["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op8_token_counts(spark, d):
    return token_counts(documents(spark, d), sentencepiece_pieces(PIECES))


@query
def op9_window_dedup(spark, d):
    cut = remove_repeated_windows(documents(spark, d))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op9_window_dedup"] = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n_words
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), windows AS (
  SELECT *, CASE WHEN pos + 19 <= n_words THEN string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS seq
  FROM words
), flagged AS (
  SELECT *, seq IS NOT NULL AND row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) > 1 AS again FROM windows
), covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM flagged
), cut AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM covered GROUP BY doc_id
)
SELECT d.doc_id, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS n_words,
       coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut USING (doc_id)
"""


@query
def op10_source_mix(spark, d):
    return mix(documents(spark, d)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op11_katz_backoff(spark, d):
    return backoff.score(documents(spark, d))


@query
def op12_pivot_codes(spark, d):
    codes = pivot_codes.product_codes(spark.read.parquet(f"{d}/embeddings.parquet"))
    return pivot_codes.with_label_errors(codes)


def _codebook_rounds(rounds: int) -> str:
    """CTEs `book_0 ...` and `near_0 ...`: the nearest entry e of every part and its squared distance."""
    step = """
near_{r} AS (
  SELECT vec_id, j, m % 64 AS e, m // 64 AS dist FROM (
    SELECT vec_id, j, min(d * 64 + e) AS m FROM (
      SELECT c.vec_id, c.j, b.e, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
      FROM comps c JOIN book_{r} b ON c.j = b.j AND c.i = b.i GROUP BY c.vec_id, c.j, b.e
    ) GROUP BY vec_id, j
  )
), book_{n} AS (
  SELECT b.j, b.e, b.i, coalesce(m.x, b.x) AS x FROM book_{r} b LEFT JOIN (
    SELECT c.j, n.e, c.i, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS x
    FROM comps c JOIN near_{r} n ON c.vec_id = n.vec_id AND c.j = n.j GROUP BY c.j, n.e, c.i
  ) m ON b.j = m.j AND b.e = m.e AND b.i = m.i
)"""
    return ",".join(step.replace("{r}", str(r)).replace("{n}", str(r + 1)) for r in range(rounds + 1))


ORACLE["op12_pivot_codes"] = f"""
WITH flat AS (
  SELECT vec_id, label, len(embedding) AS size, unnest(embedding) AS x, unnest(range(len(embedding))) AS p FROM embeddings
), kept AS (
  SELECT vec_id, label, size // 16 AS width FROM flat
  GROUP BY vec_id, label, size HAVING bool_and(x IS NOT NULL AND isfinite(x))
), comps AS (
  SELECT vec_id, p // width AS j, p % width AS i, floor(256 * x::DOUBLE)::BIGINT AS x FROM flat JOIN kept USING (vec_id)
), book_0 AS (
  SELECT j, e, i, x FROM comps
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)
), {_codebook_rounds(2)}, coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY j) AS code, sum(dist)::BIGINT AS error
  FROM near_2 GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY j, e, i)) FROM book_2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


@query
def op13_token_alignment(spark, d):
    return alignment.align(documents(spark, d), alignment.read_byte_level(BYTE_LEVEL), alignment.read_pieces(PIECES))
