"""One query for each operator of this subpackage, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import decontaminate, lm_score, mixing, suffix_dedup, topk
from loomset.llm.common import table
from loomset.llm.language import language_id
from loomset.llm.near_dedup import near_duplicates
from loomset.llm.quality import quality_scores
from loomset.llm.suffix_dedup import remove_repeats
from loomset.llm.token_counts import token_counts
from loomset.llm.warc import page_records


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 20 = 0"), k=20, scale=64)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def lm_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5_lm_score that SQL can express."""
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), tree=False).withColumn("base_score", F.round("base_score", 3))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=10).drop("items")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(table(spark, sf_dir, "pages"), least=0)


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_topk": op2_topk,
    "op3_mixing": op3_mixing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "lm_baseline": lm_baseline,
}

ORACLES: dict[str, str] = {
    "op1_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + least(4, len(w)) - 1], ' ') FOR i IN range(1, greatest(1, len(w) - 3) + 1)]) AS s FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM k JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
b AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT x, y FROM b UNION SELECT r.x, b.y FROM r JOIN b ON r.y = b.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id, d.doc_id <= coalesce(m.y, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON m.x = d.doc_id
""",
    "op2_topk": topk.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op4_suffix_dedup": suffix_dedup.ORACLE,
    "lm_baseline": lm_score.ORACLE,
    "op9_decontamination": decontaminate.ORACLE,
    "op10_warc": r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS s FROM pages),
l AS (SELECT s, min(page_id) AS low FROM p GROUP BY s)
SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1) FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> low THEN low END AS refers_to
FROM p JOIN l USING (s)
""",
}
