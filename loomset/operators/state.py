"""Incremental state: which shards were processed, which fingerprints were seen, and how much each run did.

Every attempt at a run has an identifier of its own, and every row of state carries it beside its shard's key. All tables are only
ever appended to, and `shards` last; a row of another table counts if its shard and attempt stand in `shards`. So an attempt
that dies, wherever it dies, leaves nothing that counts, and is simply run again. Outputs are partitioned by shard key and
overwritten by partition, so they are there once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "shard_key string, attempt string"
TABLES = {
    "shards": f"{KEY}, path string, sha256 string, processed_at timestamp, records long, pairs_generated long, pairs_vetted long, cells_stamped long",
    "fingerprints": f"{KEY}, fingerprint string",
    "metrics": f"{KEY}, run_id string, shard string, records long, raw long, vetted long, rejected long, cells long, errors long",
    "errors": f"{KEY}, id string, task string, error string, timestamp timestamp",
    "answered": "shard_key string, stage string",
}
COUNTERS = ("records", "raw", "vetted", "rejected", "cells", "errors")


def written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What was written to path; empty if nothing was."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def load(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of a state table that count; empty with its schema if it was never written."""
    rows = written(spark, f"{path}/{table}", TABLES[table])
    if table in ("shards", "answered"):
        return rows.distinct() if table == "answered" else rows
    done = written(spark, f"{path}/shards", TABLES["shards"]).select("shard_key", "attempt")
    return rows.join(done, ["shard_key", "attempt"], "left_semi")


def unprocessed(files: DataFrame, shards: DataFrame) -> DataFrame:
    """Files whose (path, sha256) is not in the state: edited ones are processed again."""
    return files.join(shards.select("path", "sha256").distinct(), ["path", "sha256"], "left_anti")


def shard_key(path: Column, sha256: Column) -> Column:
    """Begins with a letter, so that no reader of partitions takes it for a number."""
    return F.concat(F.lit("s"), F.sha2(F.concat_ws("|", path, sha256), 256))


def write_output(df: DataFrame, path: str, key: str = "shard_key") -> None:
    """Replaces the partitions that df has, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def append(rows: DataFrame, path: str, table: str) -> None:
    names = [x.split()[0] for x in TABLES[table].split(", ")]
    rows.select(*names).write.mode("append").parquet(f"{path}/{table}")


def commit(path: str, attempt: str, shards: DataFrame, fingerprints: DataFrame, metrics: DataFrame, errors: DataFrame) -> None:
    """Appends to the state; shards, the mark that an attempt counts, come last and at once."""
    mine = F.lit(attempt)
    append(fingerprints.select("shard_key", "fingerprint").distinct().withColumn("attempt", mine), path, "fingerprints")
    append(errors.withColumns({"attempt": mine, "timestamp": F.current_timestamp()}), path, "errors")
    append(metrics.withColumn("attempt", mine), path, "metrics")
    append(shards.withColumns({"attempt": mine, "processed_at": F.current_timestamp()}).coalesce(1), path, "shards")


def totals(metrics: DataFrame) -> DataFrame:
    """Counters over all runs."""
    return metrics.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS))


def counters(vetted: DataFrame, shard: str) -> DataFrame:
    """(shard, raw, vetted, rejected): rejections are rows of their own, never a difference that could be negative."""
    return vetted.groupBy(shard).agg(F.count("*").alias("raw"), F.count_if("passed").alias("vetted"), F.count_if(~F.col("passed")).alias("rejected"))


def stamp_of(time: Column, compact: bool = False) -> Column:
    """UTC time as text, ISO 8601 or compact; the session's time zone must be UTC."""
    return F.date_format(time, "yyyyMMdd_HHmmss" if compact else "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
