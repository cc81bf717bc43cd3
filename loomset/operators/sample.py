"""Keep-first deduplication, stratified sampling, caps and splits, all with a fixed order, so that reruns agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions import text as X

HASHES, BITS = 7, 1 << 28


def keep_first(df: DataFrame, fingerprint: Column, order: list[str]) -> DataFrame:
    """The first row, in order, of each fingerprint. Only key and order are ranked; wide rows are not sorted."""
    first = df.groupBy(fingerprint.alias("_f")).agg(F.min(F.struct(*order)).alias("_o"))
    named = df.withColumn("_f", fingerprint).withColumn("_o", F.struct(*order))
    return named.join(first, ["_f", "_o"], "left_semi").drop("_f", "_o")


def _places(key: str, bits: int) -> list[Column]:
    """HASHES places of a key among so many bits."""
    return [F.pmod(F.xxhash64(F.lit(k), F.col(key).cast("string")), F.lit(bits)) for k in range(HASHES)]


def bloom_filter(known: DataFrame, key: str, bits: int) -> np.ndarray:
    """A Bloom filter of the keys as bytes. Words of 64 bits are joined by OR before the shuffle; at most bits / 64 come back."""
    place = known.select(F.explode(F.array(*_places(key, bits))).alias("b"))
    words = place.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("x")).toPandas()
    out = np.zeros(bits // 64, dtype="<i8")
    out[words["w"].to_numpy(np.int64)] = words["x"].to_numpy(np.int64)
    return out.view(np.uint8)


def bloom_keep_new(df: DataFrame, known: DataFrame, key: str, most_bits: int = BITS) -> DataFrame:
    """Rows whose key is not known. A Bloom filter lets pass what is surely new; only what it holds back is compared exactly.

    The filter has 16 bits for each known key (one false alarm in 10^4), up to most_bits (32 MB), beyond which there are more false
    alarms and the result is the same. Null keys are new.
    """
    known = known.select(F.col(key).alias("_k")).where("_k is not null")
    bits = 1 << max(16, min(most_bits.bit_length() - 1, (16 * known.count()).bit_length()))
    table = df.sparkSession.sparkContext.broadcast(bloom_filter(known, "_k", bits))

    @F.pandas_udf("boolean")
    def maybe(places: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        t = table.value
        for cols in places:
            out = np.ones(len(cols[0]), dtype=bool)
            for c in cols:
                b = c.to_numpy(np.int64)
                out &= (t[b >> 3] >> (b & 7).astype(np.uint8) & 1).astype(bool)
            yield pd.Series(out)

    rows = df.withColumn("_maybe", F.col(key).isNotNull() & maybe(*_places(key, bits)))
    held = rows.where("_maybe")
    # the state is cut to the keys at hand first, so the anti side is small
    hits = known.join(held.select(F.col(key).alias("_k")).distinct(), "_k", "left_semi").distinct()
    return rows.where("not _maybe").select(*df.columns).union(held.join(hits, held[key] == hits["_k"], "left_anti").select(*df.columns))


def reconciled(df: DataFrame, key: str, chunk: str, order: list[str]) -> DataFrame:
    """df with state, after chunks were registered on their own: kept, `chunk duplicate` for a row whose key comes earlier in its
    chunk, and `cross duplicate` for one that is first in its chunk, but not in the first chunk that has the key.

    Two minima, each summed before the shuffle. order must tell the rows of a chunk apart. Null keys are never duplicates.
    """
    firsts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(chunk).alias("_c")).agg(F.min(F.struct(*order)).alias("_o"))
    where = firsts.join(firsts.groupBy("_k").agg(F.min("_c").alias("_first")), "_k")
    rows = df.join(where, (F.col(key) == F.col("_k")) & F.col(chunk).eqNullSafe(F.col("_c")), "left")
    state = F.when(F.col("_k").isNull(), "kept").when(F.struct(*order) != F.col("_o"), "chunk duplicate").when(~F.col("_c").eqNullSafe(F.col("_first")), "cross duplicate").otherwise("kept")
    return rows.withColumn("state", state).select(*df.columns, "state")


def strata_quota(df: DataFrame, stratum: str, cap: int, first: str) -> DataFrame:
    """(stratum, n, take): an equal share of cap for each, one more for the smallest by the remainder, never more than there is.

    cap <= 0 or a total within it takes all. Unused shares are not dealt out again. Ties in size go by first appearance.
    """
    s = df.groupBy(stratum).agg(F.count("*").alias("n"), F.min(first).alias("_first"))
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy("n", "_first")) - 1
    s = s.withColumns({"_rank": rank, "_kinds": F.count("*").over(every), "_total": F.sum("n").over(every)})
    share = F.expr(f"{cap} div _kinds") + (F.col("_rank") < F.expr(f"{cap} % _kinds")).cast("long")
    take = F.col("n") if cap <= 0 else F.when(F.col("_total") <= cap, F.col("n")).otherwise(F.least("n", share))
    return s.select(stratum, "n", take.alias("take"))


def stratified_sample(df: DataFrame, stratum: str, cap: int, key: str, seed: int = 42) -> DataFrame:
    """Rows that their stratum's quota takes, in seeded order of key.

    A stratum may be most of the data: the rank is taken among hash buckets first, so that no task sorts a stratum. A bucket
    that lies wholly within the quota is kept and one beyond it dropped; only the bucket at the edge is ranked.
    """
    quota = strata_quota(df, stratum, cap, key)
    rows = df.withColumn("_h", X.seeded_key(seed, F.col(key))).withColumn("_b", F.substring("_h", 1, 3))
    buckets = rows.groupBy(stratum, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(stratum).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = buckets.withColumn("_before", before).join(quota.select(F.col(stratum).alias("_s"), "take"), F.col(stratum).eqNullSafe(F.col("_s")))
    plan = plan.where("_before < take").select(F.col(stratum).alias("_ps"), F.col("_b").alias("_pb"), (F.col("take") - F.col("_before")).alias("_left"), "_n")
    rows = rows.join(plan, F.col(stratum).eqNullSafe(F.col("_ps")) & (F.col("_b") == F.col("_pb")))
    rank = F.row_number().over(Window.partitionBy("_ps", "_pb").orderBy("_h", key))
    return rows.withColumn("_r", rank).where("_r <= _left").select(*df.columns)


def shuffled_cap(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows in seeded order: a top-n, so no global sort."""
    return df.orderBy(X.seeded_key(seed, F.col(key)), key).limit(n)


def head_cap(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def exact_split(df: DataFrame, ratio: float, key: str, seed: int = 42) -> DataFrame:
    """df with split: eval for the first floor(n * ratio) rows in seeded order, train for the rest.

    The rank is a two-level one, over hash buckets and then within each.
    """
    rows = df.withColumn("_h", X.seeded_key(seed, F.col(key))).withColumn("_b", F.substring("_h", 1, 3))
    buckets = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_b")
    plan = buckets.select(F.col("_b").alias("_pb"), F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    rows = rows.join(F.broadcast(plan), F.col("_b") == F.col("_pb"))  # at most 4,096 buckets
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) + F.col("_before")
    cut = F.floor(F.col("_all") * F.lit(ratio))
    return rows.withColumn("split", F.when(rank <= cut, F.lit("eval")).otherwise(F.lit("train"))).select(*df.columns, "split")


def hash_split(df: DataFrame, ratio: float, key: str, seed: int = 42) -> DataFrame:
    """As exact_split, but by a threshold on the hash: no shuffle, and the share is met on average."""
    u = F.conv(F.substring(X.seeded_key(seed, F.col(key)), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return df.withColumn("split", F.when(u < ratio, F.lit("eval")).otherwise(F.lit("train")))
