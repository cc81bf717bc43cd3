"""The incremental run: discover, normalise, answer or take the given answer, vet, stamp, write, commit."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions import rules
from loomset.operators import seal, state
from loomset.operators.infer import Answer, live_pairs
from loomset.operators.normalize import backfill_pairs, unified_failures
from loomset.operators.prompts import wanted_tasks
from loomset.operators.vet import vet
from loomset.sources import records

ERRORS = "id string, shard_key string, task string, error string"


def plan(spark: SparkSession, failures: str, backfill: str, state_path: str) -> DataFrame:
    """What a run would do: (kind, path, sha256, bytes, lines). Backfill shards come first."""
    done = state.load(spark, state_path, "shards")
    out = None
    for k, (kind, path, pattern, deep) in enumerate((("backfill", backfill, "*.jsonl", False), ("failures", failures, "shard_*.jsonl", True))):
        new = state.unprocessed(records.discover(spark, path, pattern, deep), done)
        new = new.withColumn("kind", F.lit(kind)).withColumn("source_ord", F.lit(k))
        out = new if out is None else out.unionByName(new)
    return out


def _asked(answer: Answer, out: str, mine: DataFrame, tasks: list[str]) -> Callable[[DataFrame, str], DataFrame]:
    """Answers and writes the requests of a stage; shards whose answers an earlier attempt wrote are read, not asked again."""

    def keep(requests: DataFrame, stage: str) -> DataFrame:
        spark, stage = requests.sparkSession, "-".join([stage, *tasks])
        done = state.load(spark, f"{out}/state", "answered").where(F.col("stage") == stage)
        todo = mine.join(done, "shard_key", "left_anti")
        answers = answer(requests.join(todo, "shard_key", "left_semi"))
        state.write_output(answers, f"{out}/answers/{stage}")
        state.append(todo.withColumn("stage", F.lit(stage)).coalesce(1), f"{out}/state", "answered")
        return state.written(spark, f"{out}/answers/{stage}", answers.schema).join(mine, "shard_key", "left_semi")

    return keep


def run(spark: SparkSession, failures: str, backfill: str, out: str, answer: Answer | None = None, tasks: list[str] = rules.TASKS, run_id: str = "run") -> dict[str, int]:
    """Processes all new shards; returns counters of this run. Without `answer`, failure shards are left for later.

    Each step is written before the next reads it: answers by stage, then raw pairs, vetted pairs and cells, by shard, then the
    state. So each request is asked once, also by a run that repeats one that died, and a repeated run gives the same.
    """
    tasks = wanted_tasks(tasks)
    attempt = uuid.uuid4().hex
    # paths of new files: Spark's own reader holds them on the driver as well
    new = plan(spark, failures, backfill, f"{out}/state").select("kind", "path", "sha256", "source_ord").collect()
    kinds = {k: [r["path"] for r in new if r["kind"] == k and (k == "backfill" or answer)] for k in ("backfill", "failures")}
    shards = [(r["path"], r["sha256"], r["source_ord"]) for r in new if r["path"] in set(kinds[r["kind"]])]
    if not shards:
        return {"shards": 0} | dict.fromkeys(state.COUNTERS, 0)
    keys = spark.createDataFrame(shards, "source_path string, sha256 string, source_ord int").withColumn("shard_key", state.shard_key(F.col("source_path"), F.col("sha256")))
    mine = keys.select("shard_key")
    raw = read = errors = None
    for kind, paths in kinds.items():
        if not paths:
            continue
        rows, bad = (x.join(keys.select("source_path", "shard_key"), "source_path") for x in records.read_lenient(spark, paths, records.FAILURE))
        state.write_output(bad, f"{out}/quarantine")
        n = rows.groupBy("shard_key").agg(F.count("*").alias("records"))
        read = n if read is None else read.union(n)
        unified = unified_failures(rows, is_instruction=kind == "backfill")
        # the id carries the row's place through the steps that only keep an id
        unified = unified.withColumn("id", F.to_json(F.struct("id", "source_path", "line_no")))
        if kind == "backfill":
            pairs = backfill_pairs(unified).withColumn("task_ord", F.lit(0))
        else:
            unified = unified.join(keys.select("source_path", "shard_key"), "source_path")
            pairs, errors = live_pairs(unified, answer, tasks, keep=_asked(answer, out, mine, tasks), carry=("shard_key",))
            pairs = pairs.drop("shard_key")
        at = F.from_json("id", "id string, source_path string, line_no long")
        pairs = pairs.withColumn("_at", at).withColumn("id", F.col("_at.id")).withColumn("source_path", F.col("_at.source_path")).withColumn("line_no", F.col("_at.line_no")).drop("_at")
        pairs = pairs.withColumn("metadata", F.struct("metadata.failure_class", "metadata.vertical", "metadata.source_model"))
        raw = pairs if raw is None else raw.unionByName(pairs)

    def step(df: DataFrame, name: str) -> DataFrame:
        state.write_output(df, f"{out}/{name}")
        return state.written(spark, f"{out}/{name}", df.schema).join(mine, "shard_key", "left_semi")

    raw = step(raw.join(keys, "source_path"), "raw")
    checked = step(vet(raw, ["source_ord", "source_path", "line_no", "task_ord"], state.load(spark, f"{out}/state", "fingerprints").select("fingerprint")), "vetted")
    cells = step(seal.stamp(checked.where("passed"), carry=["shard_key"]), "cells")
    errors = spark.createDataFrame([], ERRORS) if errors is None else errors.withColumn("id", F.get_json_object("id", "$.id"))
    parts = [read, state.counters(checked, "shard_key"), cells.groupBy("shard_key").agg(F.count("*").alias("cells")), errors.groupBy("shard_key").agg(F.count("*").alias("errors"))]
    metrics = keys.withColumnRenamed("source_path", "shard").withColumn("run_id", F.lit(run_id))
    for p in parts:
        metrics = metrics.join(p, "shard_key", "left")
    metrics = metrics.fillna(0, list(state.COUNTERS))
    metrics = spark.createDataFrame(metrics.collect(), metrics.schema)  # a row for each new file
    done = metrics.select("shard_key", F.col("shard").alias("path"), "sha256", "records", F.col("raw").alias("pairs_generated"), F.col("vetted").alias("pairs_vetted"), F.col("cells").alias("cells_stamped"))
    state.commit(f"{out}/state", attempt, done, checked, metrics, errors)
    return {"shards": len(shards)} | state.totals(metrics).first().asDict()
