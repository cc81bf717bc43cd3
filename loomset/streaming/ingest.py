"""A streaming front to the batch operators: new files are picked up as they come.

A file source knows paths only and misses edits, so it is only told from it that files came: `curated` then makes the
incremental run, which finds what is new by (path, sha256), sends malformed lines to quarantine, meets the fingerprints of
earlier runs, and commits its state last. A batch that comes twice finds nothing to do. `read_stream` is for other work on rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomset.functions import rules
from loomset.operators.infer import Answer
from loomset.plans import curate
from loomset.sources import records


def _lines(spark: SparkSession, path: str, pattern: str, recursive: bool = False) -> DataFrame:
    stream = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return stream.text(path).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("line"))


def read_stream(spark: SparkSession, path: str, schema: str = records.FAILURE, pattern: str = "*.jsonl") -> DataFrame:
    """Records with source_path and bad_line; a malformed line is a row whose fields are null and which has it as bad_line."""
    p = records.parsed(_lines(spark, path, pattern), schema).where("not is_blank")
    return p.select("value.*", "source_path", F.when(F.col("is_bad"), F.col("line")).alias("bad_line"))


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs work on each micro-batch; work must be idempotent, as a batch may come twice."""
    w = df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def curated(spark: SparkSession, failures: str, backfill: str, out: str, answer: Answer | None, checkpoint: str, tasks: list[str] = rules.TASKS, once: bool = True) -> StreamingQuery:
    """An incremental run of `curate` for each micro-batch of new files in either folder (both must be there)."""
    came = _lines(spark, backfill, "*.jsonl").union(_lines(spark, failures, "shard_*.jsonl", recursive=True))
    return each_batch(came, lambda _batch, n: curate.run(spark, failures, backfill, out, answer, tasks, f"batch-{n}") and None, checkpoint, once)


def distinct_within(df: DataFrame, fingerprint: str, time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each fingerprint within the delay; state older than that is dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([fingerprint])
