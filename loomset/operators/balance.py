"""Checks that are specified for data sets but were left to the reader: balance, allow-lists, leaks, tiers, packing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import rules
from loomset.scratch import stash

#: Most held-out shingles that are broadcast (8 bytes each), and rows of a shard that is packed in one task.
SHINGLES, SHARD = 1 << 22, 100_000

def shares(df: DataFrame, key: str, most: float) -> DataFrame:
    """(key, n, pct, over): each value's share, and whether it is above `most` percent."""
    s = df.groupBy(key).agg(F.count("*").alias("n")).withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
    return s.withColumn("over", F.col("pct") > most)


def target_bands(df: DataFrame, key: str, targets: dict[str, tuple[int, int]] = rules.TARGET_SHARES) -> DataFrame:
    """(key, low, high, n, pct, state) for each target; state is below, within or above."""
    t = df.sparkSession.createDataFrame([(k, float(a), float(b)) for k, (a, b) in targets.items()], f"{key} string, low double, high double")
    out = t.join(shares(df, key, 100), key, "left").select(key, "low", "high", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("pct", F.lit(0.0)).alias("pct"))
    return out.withColumn("state", F.when(F.col("pct") < F.col("low"), "below").when(F.col("pct") > F.col("high"), "above").otherwise("within"))


def capped_share(others: int, share: float = 0.4) -> int:
    """Most rows of a source beside `others` rows so that it keeps within its share."""
    return int(share / (1 - share) * others)


def unexpected(df: DataFrame, value: str, allowed: DataFrame) -> DataFrame:
    """Rows whose value is not allowed."""
    return df.join(allowed.select(value).distinct(), value, "left_anti")


def leaked(df: DataFrame, held_out: DataFrame, text: str = "text", words: int = 8) -> DataFrame:
    """Rows of df that share a run of `words` words with a held-out text.

    Shingles of df are not shuffled as long as those held out fit SHINGLES: they are then broadcast, and only digests of the
    texts that have one of them go on. Beyond that both sides are shuffled by shingle.
    """

    def shingles(x: DataFrame, keep: list) -> DataFrame:
        w = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\n\r\f\x0b]+"), lambda v: v != "")
        at = F.when(F.size("_w") >= words, F.sequence(F.lit(0), F.size("_w") - words)).otherwise(F.array().cast("array<int>"))
        return x.withColumn("_w", w).select(*keep, F.explode(F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.slice("_w", i + 1, words))))).alias("_s"))

    known = stash(shingles(held_out, []).distinct(), "held-out-shingles")
    if known.count() <= SHINGLES:
        known = F.broadcast(known)
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    hit = shingles(df, [digest.alias("_d")]).join(known, "_s", "left_semi").select("_d").distinct()
    return df.join(hit, digest == F.col("_d"), "left_semi")


def tier(score: Column) -> Column:
    # Grades and their least scores.
    return F.when(score >= 80, F.lit("honey")).when(score >= 60, F.lit("cluster")).otherwise(F.lit("cell"))


def tiers(df: DataFrame, score: str) -> DataFrame:
    return df.groupBy(tier(F.col(score)).alias("tier")).agg(F.count("*").alias("n"))


def by_domain(df: DataFrame, domain: str, score: str) -> DataFrame:
    """(domain, n, pct, avg_score)."""
    s = df.groupBy(domain).agg(F.count("*").alias("n"), F.round(F.avg(score), 1).alias("avg_score"))
    return s.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def by_configuration(df: DataFrame, config: str, score: str, top: int = 80) -> DataFrame:
    """(config, n, avg_score, top_rate): quality of each generation setting."""
    return df.groupBy(config).agg(F.count("*").alias("n"), F.round(F.avg(score), 1).alias("avg_score"), F.round(100 * F.count_if(F.col(score) >= top) / F.count("*"), 4).alias("top_rate"))


def weighted(df: DataFrame, kind: str, copies: dict[str, int]) -> DataFrame:
    """Each row as often as its kind says (once if it doesn't), numbered copy from 1."""
    n = None
    for k, v in copies.items():
        n = F.when(F.col(kind) == k, v) if n is None else n.when(F.col(kind) == k, v)
    n = F.lit(1) if n is None else n.otherwise(1)
    return df.withColumn("_n", n).where("_n > 0").select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))


def invalid_json(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.col(text).isNull() | F.try_parse_json(F.col(text)).isNull())


def token_estimate(text: Column) -> Column:
    return F.ceil(F.length(text) / 4).cast("long")


def packed(df: DataFrame, tokens: str, order: str, size: int = 4096, shards: int | None = None) -> DataFrame:
    """df with shard and bin: next-fit packing of sequences of at most `size` tokens, within shards by hash of the order key.

    A longer sequence has a bin of its own; null counts as 0 tokens. Bins are independent between shards, of which there is one for
    about SHARD rows, so packing is parallel. A shard is read in order; the end of each bin is found in the running sum.
    """
    if shards is None:
        shards = max(1, -(-df.count() // SHARD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bin_, used = None, 0, 0
        for batch in batches:
            shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            n = batch.column(batch.schema.get_field_index(tokens)).cast(pa.int64()).fill_null(0).to_numpy()
            bins = np.zeros(len(n), dtype=np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(n)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if shard[a] != last:
                    last, bin_, used = shard[a], 0, 0
                total, at = np.cumsum(n[a:b]), 0
                while at < b - a:
                    before = int(total[at - 1]) if at else 0
                    to = int(np.searchsorted(total, before + size - used, side="right"))
                    if to <= at and used:
                        bin_, used = bin_ + 1, 0
                        continue
                    to = max(to, at + 1)
                    bins[a + at : a + to] = bin_
                    used += int(total[to - 1]) - before
                    at = to
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bins)], [*batch.schema.names, "bin"])

    key = F.conv(F.substring(F.md5(F.col(order).cast("string")), 1, 8), 16, 10).cast("long")
    rows = df.withColumn("shard", F.coalesce(key, F.lit(0)) % shards).repartition("shard").sortWithinPartitions("shard", order)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add("bin", "long"))


def taxonomy(spark, groups: dict[str, list[str]] = rules.TAXONOMY) -> DataFrame:
    return spark.createDataFrame([(g, m) for g, ms in groups.items() for m in ms], "family string, mode string")
