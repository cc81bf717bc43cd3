"""Assembly of a data set from its sources, and its outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.functions import text as X
from loomset.operators.sample import exact_split, keep_first, shuffled_cap
from loomset.scratch import stash

ORDER = ["source_ord", "source_path", "line_no"]


def bag_union(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, in order of source_ord; columns that a part lacks are null."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("source_ord", F.lit(k))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def counts_by(df: DataFrame, key: Column, name: str, order: str) -> DataFrame:
    """(name, n, pct) by n descending; ties by first appearance."""
    c = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    c = c.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
    return c.orderBy(F.col("n").desc(), "_first").select(name, "n", "pct")


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """(before, after, removed, pct); pct is null without rows."""
    n = before.agg(F.count("*").alias("before")).crossJoin(after.agg(F.count("*").alias("after")))  # one row each
    return n.select("before", "after", (F.col("before") - F.col("after")).alias("removed"), F.round(100 * (F.col("before") - F.col("after")) / F.nullif(F.col("before"), F.lit(0)), 4).alias("pct"))


def assemble(parts: list[DataFrame], cap: int = 0, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """Union, keep-first deduplication on the first answer, an optional cap, and the split.

    The union is written once, with fingerprints and row numbers. All is decided on these and the order, without messages, which
    are joined to the rows that stay.
    """
    df = bag_union(parts)
    key = F.concat_ws("|", *(F.col(c).cast("string") for c in ORDER))
    df = stash(df.withColumns({"_f": X.answer_fingerprint(F.col("messages")), "_key": key, "_row": F.monotonically_increasing_id()}), "union")
    rows = keep_first(df.select(*ORDER, "_f", "_key", "_row"), F.col("_f"), ORDER)
    if cap > 0:
        rows = shuffled_cap(rows, cap, "_key", seed)
    rows = exact_split(rows, ratio, "_key", seed).select("_row", "split")
    return df.join(rows, "_row").drop("_f", "_key", "_row")


def write_full(df: DataFrame, path: str) -> None:
    """Everything as Parquet under full/, so that sources stay known."""
    df.write.mode("overwrite").parquet(f"{path}/full")


def write_lines(spark: SparkSession, path: str) -> None:
    """messages of what full/ holds as JSON lines under train/ and eval/."""
    full = spark.read.parquet(f"{path}/full")
    for part in ("train", "eval"):
        full.where(F.col("split") == part).select("messages").write.mode("overwrite").json(f"{path}/{part}")


def write_split(df: DataFrame, path: str) -> None:
    """Both; df is computed once."""
    write_full(df, path)
    write_lines(df.sparkSession, path)


def rendered(messages: Column, start: str = "<|{role}|>\n", end: str = "\n<|end|>\n") -> Column:
    """Chat text from an own template: start with the role, content, end, for each message."""
    a, _, b = start.partition("{role}")
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(a), F.coalesce(m["role"], F.lit("?")), F.lit(b), X.text_or_empty(m["content"]), F.lit(end))), "")


def training_steps(n: Column, batch: int = 32, epochs: float = 0.8) -> Column:
    return F.floor(F.floor(n / batch) * F.lit(epochs)).cast("long")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of whole files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("sha256"))
