"""The queries of this subpackage: thin digests of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, ctw, embeddings, flac, langid, licenses, packing, quality, simhash, tokencounts
from .common import remainder_is_one, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(~remainder_is_one("doc_id", 3)))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", remainder_is_one("doc_id", 3).alias("held_out"), "score", "predicted")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.select("doc_id", "text", "lang").filter(~remainder_is_one("doc_id", 3)))
    found = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", remainder_is_one("doc_id", 3).alias("held_out"), "lang_pred", "score")


def op3_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), remainder_is_one("doc_id", 5))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    first = F.coalesce(F.array_min(F.transform("matches", lambda m: m["first_sentence"])), F.lit(-1).cast("long"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("matches").cast("long").alias("n_matches"), first.alias("first_sentence"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, words=4, radius=4, keep=["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), window=1024, with_ids=False)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after the edits that redact personal data."""
    docs = tokencounts.find_edits(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id", "text"])
    counted = tokencounts.count(docs, keep=["doc_id", "text", "edits"])
    after = tokencounts.recount(counted, keep=["doc_id", "n_tokens"])
    return after.select("doc_id", "n_tokens", "n_edits", "tokens_after", "chars_after", F.sha2("edited_text", 256).alias("text_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


def op9_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = flac.write_media(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return flac.read_media(stored, keep=["doc_id", "n_bytes"])


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_language": op2_language,
    "op3_ctw": op3_ctw,
    "op4_licenses": op4_licenses,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_token_counts": op7_token_counts,
    "op8_bpe": op8_bpe,
    "op9_flac": op9_flac,
    "op10_embeddings": op10_embeddings,
}

#: DuckDB SQL of those queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_licenses": licenses.oracle(),
    "op10_embeddings": """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), first AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, f.component_id, coalesce(v.vec_id = f.component_id, false) AS kept
FROM embeddings v LEFT JOIN counted c ON v.vec_id = c.a LEFT JOIN first f ON v.vec_id = f.node
""",
}
