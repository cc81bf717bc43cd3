"""Vetting of pairs by five gates, of which four are enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import rules
from loomset.functions import text as X

ROLES = ("system", "user", "assistant")
GATES = ("source_tags", "content_length", "degenerate", "coherence")


def source_tags(messages: Column) -> Column:
    """At least one message; known roles; contents that are more than white space."""
    good = F.forall(messages, lambda m: F.coalesce(m["role"].isin(*ROLES), F.lit(False)) & (X.strip(X.text_or_empty(m["content"])) != ""))
    return (F.size(messages) >= 1) & F.coalesce(good, F.lit(False))


def coherent(task: Column, answer: Column, keywords: dict[str, list[str]] = rules.TASK_KEYWORDS) -> Column:
    """Whether the answer holds a keyword of its task; an unknown task has none."""
    low, out = F.lower(answer), None
    for name, words in keywords.items():
        out = F.when(task == name, X.contains_any(low, words)) if out is None else out.when(task == name, X.contains_any(low, words))
    return out.otherwise(F.lit(False))


def first_seen(df: DataFrame, key: str, order: list[str], known: DataFrame | None = None) -> DataFrame:
    """df with unseen: the row is the first with its key, in order, and the key is not among known (one column, of that name).

    order must tell rows apart: rows that tie for the first place are all first. The first place is a minimum by key, summed
    before the shuffle, and comes back by a join, of which a hot key's side can be split; no task ranks a key's rows. Known
    keys are found by a semi join on the keys at hand, which prunes the state.
    """
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*order)).alias("_first"))
    if known is not None:
        hits = known.select(F.col(key).alias("_key")).join(first.select("_key"), "_key", "left_semi").distinct().withColumn("_seen", F.lit(True))
        first = first.join(hits, "_key", "left")
    else:
        first = first.withColumn("_seen", F.lit(None).cast("boolean"))
    unseen = F.col("_seen").isNull() & (F.struct(*order) == F.col("_first"))
    return df.join(first, F.col(key).eqNullSafe(F.col("_key"))).withColumn("unseen", unseen).drop("_key", "_first", "_seen")


def vet(pairs: DataFrame, order: list[str], known: DataFrame | None = None, fingerprint: Column | None = None, keywords: dict[str, list[str]] = rules.TASK_KEYWORDS) -> DataFrame:
    """pairs (messages, task) with fingerprint, the five gates, gates, passed, score and reason.

    A key counts as seen whether or not its row passes, so the first place by key is the sequential rule. A repeated pair that passes all
    other gates is kept, with score 60; repetition is never named as a reason.
    """
    answer = X.text_or_empty(X.last_content(F.col("messages"), "assistant"))
    df = pairs.withColumn("fingerprint", X.conversation_hash(F.col("messages")) if fingerprint is None else fingerprint)
    # none is ever null: for one that may be, a filter would be inferred that computes it once more
    gates = {"source_tags": source_tags(F.col("messages")), "content_length": F.length(answer) >= rules.MIN_ASSISTANT, "degenerate": F.coalesce(~X.degenerate(answer), F.lit(False)), "coherence": coherent(F.col("task"), answer, keywords)}
    # below the join, which keeps a filter on the result from computing them again, and messages out of the shuffle where none are asked for
    gated = df.withColumns({f"gate_{k}": v for k, v in gates.items()})
    return scored(first_seen(gated, "fingerprint", order, known))


def scored(df: DataFrame) -> DataFrame:
    """df with the gate columns and unseen -> gates, passed, score and reason."""
    n = sum((F.col(f"gate_{k}").cast("int") for k in GATES), F.col("unseen").cast("int"))
    failed = F.concat_ws(", ", *(F.when(~F.col(f"gate_{k}"), F.lit(k)) for k in GATES))
    df = df.withColumn("gates", n)
    return df.withColumns({
        "passed": F.col("gates") >= 4,
        "score": F.when(F.col("gates") == 5, 70).when(F.col("gates") == 4, 60).otherwise(10 * F.col("gates")),
        "reason": F.when(F.col("gates") >= 4, F.lit("pass")).otherwise(F.concat(F.lit("failed gates: "), failed)),
    })
