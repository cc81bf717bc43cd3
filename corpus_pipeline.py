"""From documents to a mixed training corpus: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next. All
but the last return the columns of documents.

1. language: documents whose text has no language go: it is null, has no letters, or holds no n-gram that any learned language
   has. Where nothing could be learned, only those without letters go.
2. near_duplicates: one document of each group of near copies stays, that with the smallest id (shingles of five words,
   similarity 0.8 or more); of rows with one id, one stays. Rows with a null id belong to no group and stay.
3. suffix_repeats: bytes covered by strings of 200 bytes that occur twice are cut out; a character that is cut in part goes
   too. n_chars follows. Documents of which nothing is left but white space go.
4. decontamination: documents that contain a window of ten words of a benchmark item go.
5. mixing: how many words of each document the mix takes, and at which positions of training.

Nulls and edge cases, of every stage: columns beyond those of documents are left behind, whatever their names. Any column may
be null: a null text goes in stage 1, and counts as empty in a later stage that is called by itself; null ids are documents of
their own; a null language is not learned from; a null source is a source. Rows that are equal in all are one document from
stage 2 on. Ties go to the smaller id. Texts are read whole, whatever their length. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.common import table
from loomset.llm.decontaminate import contamination
from loomset.llm.language import held_out, identify, learn
from loomset.llm.mixing import mix_sources
from loomset.llm.near_dedup import near_duplicates
from loomset.llm.suffix_dedup import remove_repeats
from loomset.scratch import drop, new_path, scratch, stash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REST = [c for c in COLUMNS if c != "text"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learn(docs.where(~held_out(F.col("doc_id"), 0)), "text", "lang")
    if model is None:  # nothing to tell languages by
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    return identify(docs, model, REST, keep_text=True).where("lang_pred <> 'und' and score > 0").select(*COLUMNS)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped = stash(near_duplicates(docs, words=5, percent=80).where("not kept").select("doc_id").distinct(), "dropped")
    named = docs.where("doc_id is not null").join(dropped, "doc_id", "left_anti")
    again = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    once = named.join(again, "doc_id", "left_anti").select(*COLUMNS)
    first = named.join(again, "doc_id").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("x")).select("doc_id", "x.*")
    return once.union(first).union(docs.where("doc_id is null").select(*COLUMNS))


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = remove_repeats(docs, length=200, carry=["doc_id", "lang", "source"])
    out = out.where(r"n_removed = 0 or text rlike '[^\\x20\\x09-\\x0D]'")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*REST).alias("document"), "text")
    out = contamination(rows, table(spark, sf_dir, "benchmark"), words=10, id_col="document", keep_text=True)
    return out.where("not contaminated").select("document.*", "text").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, carry=["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate_groups),
    ("suffix_repeats", suffix_repeats),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Stages 2 and 3 have no SQL that is fast enough on whole tables; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; only the last one's output is left there."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            drop(spark, before)
        before = path
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
