"""Queries opN over the training-data tables, and the staged pipeline, for ``__spark_entry__``.

``ORACLE`` has the DuckDB SQL of those that SQL can express.  The others (models, tokenizers, trees, components, iterated
codebooks, strings of 200 bytes at every position) are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (adaptive_scan, bitmask_langid, chunked_bpe, credential_links, ctw, fill_middle, orchard_codes, pairwise_quality, prefix_doubling, qgram_decontam,
                         signature_join, token_counts, tree_extract)
from gleaner.llm.tables import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree weighting scores of every document, next to a smoothed unigram score."""
    return ctw.score(_table(spark, sf_dir, "documents"), held_out("doc_id", 5, 1))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors by cosine of every 50th vector."""
    return adaptive_scan.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return tree_extract.extract(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by Jaccard similarity of at least 0.85 on 4-word shingles."""
    return signature_join.join(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality score of every document; a quarter of the ids is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    return pairwise_quality.score(docs, pairwise_quality.train(docs.where("not held_out"), labels), ["doc_id", "held_out"])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: a row for each leak."""
    found = qgram_decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return chunked_bpe.digests(chunked_bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the ids is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    return bitmask_langid.predict(docs, bitmask_langid.train(docs.where("not held_out")), ["doc_id", "held_out"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, weak ones only where their parts co-occur."""
    return credential_links.report(_table(spark, sf_dir, "documents"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that start anywhere else too, as digests."""
    return prefix_doubling.digests(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, their errors and the digest of the codebooks."""
    return orchard_codes.compress(_table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, as digests of the output and of the text restored from it."""
    return fill_middle.digests(fill_middle.transform(_table(spark, sf_dir, "documents"), ["doc_id"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_lm_score, op2_nearest, op3_main_text, op4_near_duplicates, op5_quality, op6_decontaminate, op7_bpe, op8_language, op9_token_counts, op10_secrets,
    op11_repeats, op12_vector_codes, op13_fill_middle)}

_SPACE = r"\x20\x09-\x0D"
ORACLE: dict[str, str] = {"op13_fill_middle": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+') AS units,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
      FROM d),
c AS (SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""}
