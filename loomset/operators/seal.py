"""Stamped cells, the hash seal over their fingerprints, and the ledger batch. Nothing is sent anywhere."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import text as X
from loomset.operators.balance import tier
from loomset.scratch import stash

LEVELS = 10
MODEL, SCRIPT, SKILL = "curator", "loomset", "selfheal"


def domain(vertical: Column) -> Column:
    return F.when(vertical.isNull() | (vertical == "failure_analysis"), F.lit("general")).otherwise(vertical)


def stamp(vetted: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Cells from vetted pairs (id, task, messages, metadata, score); a missing score is 70, a missing task is the skill.

    A column answer, if there is one, holds the answer's fingerprint, and messages aren't asked for.
    """
    answer = F.col("answer") if "answer" in vetted.columns else X.answer_fingerprint(F.col("messages"))
    task = F.coalesce(F.col("task"), F.lit(SKILL))
    cells = vetted.select(
        X.prefix(X.sha256(F.concat_ws("|", answer, task, F.col("id").cast("string"))), 32).alias("cell_id"), answer.alias("fingerprint"), domain(F.col("metadata.vertical")).alias("domain"), task.alias("task_type"),
        F.coalesce(F.col("score"), F.lit(70)).alias("verification_score"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("source_pair_id"), F.lit(SKILL).alias("skill"), F.lit(MODEL).alias("gen_model"),
        F.coalesce(F.col("metadata.failure_class"), F.lit("")).alias("failure_class"), F.coalesce(F.col("metadata.source_model"), F.lit("")).alias("source_model"),
        *(carry or []),
    )
    return cells.withColumn("grade", tier(F.col("verification_score")))


def hash_root(leaves: DataFrame, value: str, order: str) -> str:
    """Root of the binary tree over values in order: parent = SHA-256 of left and right as hex, an odd last one pairs with itself.

    Leaves are numbered by a range sort and the sizes of its partitions, so no task sees them all, and written. A round folds
    up to 2**LEVELS neighbours, one group of bounded size, and is written too. Without leaves: SHA-256 of "".
    """
    spark = leaves.sparkSession
    parts = leaves.select(F.col(order).alias("o"), F.col(value).alias("h")).repartitionByRange("o").sortWithinPartitions("o").select("h", F.monotonically_increasing_id().alias("m"))
    parts = stash(parts, "leaves")
    sizes = sorted((r[0], r[1]) for r in parts.groupBy(F.shiftright("m", 33).alias("p")).count().collect())  # one row for each partition
    at, rows = 0, []
    for p, n in sizes:
        rows.append((p, at))
        at += n
    if not at:
        return hashlib.sha256(b"").hexdigest()
    start = spark.createDataFrame(rows, "p long, start long")
    level = parts.join(start, F.shiftright("m", 33) == F.col("p")).select((F.col("start") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("i"), "h")
    n = at
    while n > 1:
        k = min(LEVELS, (n - 1).bit_length())
        level = stash(_folded(level, k), "level")
        n = -(-n // (1 << k))
    return level.first()["h"]


def _folded(level: DataFrame, levels: int) -> DataFrame:
    """(i, h) some levels higher: each group of 2**levels neighbours is one row."""

    def parents(h: Column) -> Column:
        pair = F.sequence(F.lit(0), F.floor((F.size(h) - 1) / 2).cast("int"))
        return F.transform(pair, lambda k: F.sha2(F.concat(F.get(h, 2 * k), F.coalesce(F.get(h, 2 * k + 1), F.get(h, 2 * k))), 256))

    group = level.groupBy(F.expr(f"i div {1 << levels}").alias("i")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]).alias("h"))
    start = F.col("h").cast("array<string>")
    return group.select("i", F.get(F.reduce(F.sequence(F.lit(1), F.lit(levels)), start, lambda h, _: parents(h)), F.lit(0)).alias("h"))


def average_score(cells: DataFrame, score: str = "verification_score") -> DataFrame:
    """(avg_score): over scores that are neither null nor 0, to one decimal; 0 if there is none."""
    return cells.agg(F.coalesce(F.round(F.avg(F.nullif(F.col(score), F.lit(0))), 1), F.lit(0.0)).alias("avg_score"))


def grade_distribution(cells: DataFrame) -> DataFrame:
    """(grades): map of grade to count."""
    g = cells.groupBy(F.coalesce("grade", F.lit("cell")).alias("g")).agg(F.count("*").alias("n"))
    return g.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("g", "n")))).alias("grades"))


def ledger_pairs(cells: DataFrame) -> DataFrame:
    """The nine fields of a batch's pairs, with defaults."""
    c = lambda name, d: F.coalesce(F.col(name), F.lit(d))
    return cells.select(
        c("cell_id", "").alias("pair_id"), c("fingerprint", "").alias("fingerprint"), c("domain", "general").alias("domain"), c("task_type", SKILL).alias("task_type"), c("verification_score", 0).alias("score"),
        c("grade", "cell").alias("tier"), F.lit(MODEL).alias("gen_model"), F.lit(SCRIPT).alias("cook_script"), c("source_pair_id", "").alias("source_file"),
    )


def batch_id(root: Column, marker: str = "BATCH-LS-") -> Column:
    return F.concat(F.lit(marker), X.prefix(X.sha256(root), 12))


def batch_header(cells: DataFrame, root: str) -> DataFrame:
    """One row: batch_id, domain, merkle_root, gate_pass_rate, avg_score, tier_distribution, contamination_rate, think_tags_found."""
    return average_score(cells).crossJoin(grade_distribution(cells)).select(  # one row each
        batch_id(F.lit(root)).alias("batch_id"), F.lit("general").alias("domain"), F.lit(root).alias("merkle_root"), F.lit(1.0).alias("gate_pass_rate"), "avg_score", F.col("grades").alias("tier_distribution"),
        F.lit("").alias("audit_timestamp"), F.lit(0.0).alias("contamination_rate"), F.lit(0).alias("think_tags_found"),
    )


def ledger_batch(cells: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Header row and pair rows of a batch; pairs stay a table, as they may be many. Cells are written once, and all is read from there."""
    cells = stash(cells, "cells")
    return batch_header(cells, hash_root(cells, "fingerprint", order)), ledger_pairs(cells)


def mark_pushed(cells: DataFrame, batch: str) -> DataFrame:
    return cells.withColumn("pushed_in", F.lit(batch))


def lineage(train_hash: str, run_date: str, pairs: int, loss: float, spark) -> DataFrame:
    """The payload that ties a model to its training data."""
    return spark.createDataFrame([(MODEL, f"BATCH-LS-{train_hash[:12]}", f"run-{run_date[:10]}", pairs, loss, 0.0, run_date)], "model_id string, batch_id string, training_run_id string, pairs_used long, loss double, eval_loss double, trained_at string")


def manifest(df: DataFrame) -> DataFrame:
    """One-row tables -> (manifest): JSON text of the row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("manifest"))


def run_totals(metrics: DataFrame) -> DataFrame:
    """Per-shard metrics with a line of totals (shard null)."""
    return metrics.rollup("shard").agg(*(F.sum(c).alias(c) for c in ("records", "raw", "vetted", "cells", "errors")))

