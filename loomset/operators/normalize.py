"""Projections that bring records of several forms to one: unified failures, pairs and judge traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import rules
from loomset.functions import text as X


def _or(x: Column, default: str) -> Column:
    return F.coalesce(x, F.lit(default))


def nested_failures(df: DataFrame) -> DataFrame:
    """Failure records of the nested form -> unified failures. A null struct counts as empty."""
    return df.select(
        _or(F.col("id"), "unknown").alias("id"), _or(F.col("failure_class"), "unknown").alias("failure_class"), _or(F.col("vertical"), "general").alias("vertical"), _or(F.col("source_model"), "unknown").alias("source_model"),
        _or(F.col("context.user_prompt"), "").alias("user_prompt"), _or(F.col("context.model_output"), "").alias("model_output"), _or(F.col("context.system_prompt"), "").alias("system_prompt"),
        F.coalesce(F.col("failure_details.errors"), F.array().cast("array<string>")).alias("errors"), *_rest(df),
    )


def instruction_failures(df: DataFrame) -> DataFrame:
    """Instruction records -> unified failures; the class is the third part of the source's name, with all that follows."""
    return df.select(
        _or(F.col("id"), "unknown").alias("id"), _or(X.split_part_rest(F.col("source"), "_", 3, 2), "unknown").alias("failure_class"), _or(F.col("vertical"), "general").alias("vertical"),
        F.coalesce(F.col("lineage.gen_model"), F.col("specialty"), F.lit("unknown")).alias("source_model"), _or(F.col("instruction"), "").alias("user_prompt"), _or(F.col("output"), "").alias("model_output"),
        F.lit("").alias("system_prompt"), F.array().cast("array<string>").alias("errors"), *_rest(df),
    )


def _rest(df: DataFrame) -> list[Column]:
    """Order keys, and the source's name for the task that it means."""
    return [F.col(c) for c in ("source", "source_path", "line_no") if c in df.columns]


def unified_failures(df: DataFrame, is_instruction: bool = False) -> DataFrame:
    """Each row by its own form: an instruction record if the shard is one or the key is there."""
    by_key = F.lit(is_instruction) | F.col("instruction").isNotNull()
    a, b = instruction_failures(df.where(by_key)), nested_failures(df.where(~by_key))
    return a.unionByName(b)


def instruction_pairs(df: DataFrame, source: str, system_prompt: str = rules.SYSTEM_PROMPT) -> DataFrame:
    """Instruction records -> training pairs: stripped, dropped without instruction or output, reasoning before the output."""
    i, r, o = (X.strip(X.text_or_empty(F.col(c))) for c in ("instruction", "reasoning", "output"))
    answer = F.when(r != "", F.concat_ws("\n\n", r, o)).otherwise(o)
    meta = F.struct(F.lit(source).alias("source"), _or(F.col("vertical"), "").alias("vertical"), _or(F.col("mechanism"), "").alias("mechanism"), _or(F.col("fingerprint"), "").alias("fingerprint"), F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    messages = F.array(X.message("system", F.lit(system_prompt)), X.message("user", i), X.message("assistant", answer))
    return df.where((i != "") & (o != "")).select(messages.alias("messages"), meta.alias("metadata"), *(F.col(c) for c in ("source_path", "line_no") if c in df.columns))


def backfill_pairs(failures: DataFrame, system_prompt: str = rules.SYSTEM_PROMPT) -> DataFrame:
    """Unified failures that already hold an answer -> pairs; rows without prompt or output go, reasoning is not kept."""
    messages = F.array(X.message("system", F.lit(system_prompt)), X.message("user", F.col("user_prompt")), X.message("assistant", F.col("model_output")))
    return failures.where("user_prompt <> '' and model_output <> ''").select("id", source_task(F.col("source")).alias("task"), messages.alias("messages"), F.struct("failure_class", "vertical", "source_model").alias("metadata"))


def source_task(source: Column, names: dict[str, list[str]] = rules.SOURCE_TASKS) -> Column:
    return X.first_match(X.text_or_empty(source), names, "diagnose")


def failure_type(text: Column, names: dict[str, list[str]] = rules.FAILURE_TYPES) -> Column:
    return X.first_match(F.lower(X.text_or_empty(text)), names, "other")


def judge_traces(df: DataFrame, names: dict[str, list[str]] = rules.FAILURE_TYPES, min_messages: int = 2, min_length: int = rules.MIN_TRACE) -> DataFrame:
    """Traces with enough messages and text, classified by their first user message."""
    user = X.text_or_empty(X.first_content(F.col("messages"), "user"))
    good = (F.size("messages") >= min_messages) & (X.total_length(F.col("messages")) >= min_length)
    vertical = F.col("metadata.vertical") if "metadata" in df.columns else F.lit(None).cast("string")
    meta = F.struct(F.lit("judge_trace").alias("source"), _or(vertical, "judge").alias("vertical"), failure_type(user, names).alias("failure_type"))
    return df.where(good).select("messages", meta.alias("metadata"), *(F.col(c) for c in df.columns if c not in ("messages", "metadata")))


def conversation_messages(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turn, role, text) rows -> one row for each key with messages in turn order."""
    rows = F.array_sort(F.collect_list(F.struct("turn", F.col("role"), F.col("text").alias("content"))))
    return turns.groupBy(key).agg(rows.alias("m")).select(key, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
