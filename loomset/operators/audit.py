"""Audit of conversations: gates of which the first failure counts, profiles, and the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions import rules
from loomset.functions import text as X
from loomset.operators.sample import shuffled_cap


def format_reason(messages: Column, form: Column | None = None) -> Column:
    """Null if there are at least two messages. form, where it is known, tells absent messages from what is no list of them."""
    few = F.when(F.size(messages) < 2, F.concat(F.lit("messages: "), F.size(messages), F.lit(", at least 2 are needed")))
    if form is None:
        return F.when(messages.isNull(), F.lit("no messages")).otherwise(few)
    return F.when(form == "absent", F.lit("no messages")).when((form != "list") | messages.isNull(), F.lit("messages are no list of objects")).otherwise(few)


def roles_reason(messages: Column) -> Column:
    """There must be an assistant and a user; a system message comes first. Other roles and any order are allowed."""
    r = X.roles(messages)
    return (
        F.when(~F.array_contains(r, "assistant"), F.lit("the assistant is missing"))
        .when(~F.array_contains(r, "user"), F.lit("the user is missing"))
        .when(F.array_contains(r, "system") & (F.get(r, F.lit(0)) != "system"), F.lit("a system message comes late"))
    )


def content_reason(messages: Column) -> Column:
    """The first message, in order, that is empty, or too short for an assistant or a user, when stripped."""

    def reason(m: Column) -> Column:
        role, n = F.coalesce(m["role"], F.lit("?")), F.length(X.strip(X.text_or_empty(m["content"])))
        short = ((role == "assistant") & (n < rules.MIN_ASSISTANT)) | ((role == "user") & (n < rules.MIN_USER))
        return F.when(n == 0, F.concat(role, F.lit(" is empty"))).when(short, F.concat(role, F.lit(" has only "), n, F.lit(" characters")))

    return F.get(F.filter(F.transform(messages, reason), lambda r: r.isNotNull()), F.lit(0))


def degenerate_reason(messages: Column) -> Column:
    bad = F.get(F.filter(messages, lambda m: X.degenerate(X.text_or_empty(m["content"]))), F.lit(0))
    return F.when(bad.isNotNull(), F.concat(F.coalesce(bad["role"], F.lit("?")), F.lit(" repeats itself")))


def length_reason(messages: Column, most: int = rules.MAX_TOTAL) -> Column:
    n = X.total_length(messages)
    return F.when(n > most, F.concat(n, F.lit(f" characters in all, over {most}")))


def gated(df: DataFrame, check_degenerate: bool = False) -> DataFrame:
    """df (messages) with gate and detail of the first gate that fails, both null for clean rows.

    Columns form and line_no, as `records.read_for_audit` gives them, are used if they are there: details begin with the line.
    """
    form = F.col("form") if "form" in df.columns else None
    gates = [("format", lambda m: format_reason(m, form)), ("roles", roles_reason), ("content", content_reason)]
    gates += [("degenerate", degenerate_reason)] * check_degenerate + [("length", length_reason)]
    gate = detail = None
    for name, f in gates:
        r = f(F.col("messages"))
        gate = F.when(r.isNotNull(), F.lit(name)) if gate is None else gate.when(r.isNotNull(), F.lit(name))
        detail = F.when(r.isNotNull(), r) if detail is None else detail.when(r.isNotNull(), r)
    if "line_no" in df.columns:
        detail = F.concat(F.lit("line "), F.col("line_no"), F.lit(": "), detail)
    return df.withColumns({"gate": gate, "detail": detail})


def file_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `records.read_for_audit` -> records, for all that audits conversations, and lines that hold none."""
    return lines.where("form <> 'bad'"), lines.where("form = 'bad'").select("source_path", "line_no")


def first_failures(df: DataFrame) -> DataFrame:
    """(gate, n): rows by first failing gate, clean ones under clean."""
    return gated(df).groupBy(F.coalesce("gate", F.lit("clean")).alias("gate")).agg(F.count("*").alias("n"))


def _share(df: DataFrame, total: Column) -> DataFrame:
    return df.withColumn("pct", F.round(100 * F.col("n") / total, 4))


def histogram(df: DataFrame, key: Column, name: str, top: int | None = None) -> DataFrame:
    """(name, n, pct) by n descending, then name; pct of all rows of df."""
    counts = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))
    counts = _share(counts, F.sum("n").over(Window.partitionBy())).orderBy(F.col("n").desc(), name)
    return counts.limit(top) if top else counts


def system_prompts(df: DataFrame, top: int = 10, cut: int = 100) -> DataFrame:
    """(prompt, n, pct): first characters of each system message; pct of conversations, not of prompts."""
    total = df.agg(F.count("*").alias("_total"))
    prompts = df.select(F.explode(X.of_role(F.col("messages"), "system")).alias("m")).groupBy(X.prefix(X.text_or_empty(F.col("m.content")), cut).alias("prompt")).agg(F.count("*").alias("n"))
    return prompts.crossJoin(F.broadcast(total)).select("prompt", "n", F.round(100 * F.col("n") / F.col("_total"), 4).alias("pct")).orderBy(F.col("n").desc(), "prompt").limit(top)  # one row of totals


def system_prompt_kinds(df: DataFrame, cut: int = 100) -> DataFrame:
    """(prompts): distinct beginnings of system prompts that come first."""
    m = F.get(F.col("messages"), F.lit(0))
    return df.where(m["role"] == "system").agg(F.count_distinct(X.prefix(X.text_or_empty(m["content"]), cut)).alias("prompts"))


def role_sequences(df: DataFrame, top: int = 5) -> DataFrame:
    return histogram(df, F.array_join(X.roles(F.col("messages")), X.BRANCH), "roles", top)


def message_counts(df: DataFrame) -> DataFrame:
    return histogram(df, F.size("messages"), "messages").orderBy("messages")


def length_rows(df: DataFrame) -> DataFrame:
    """(kind, len): length of each assistant and user message, and of each conversation."""
    each = df.select(F.explode("messages").alias("m")).where("m.role in ('assistant', 'user')").select(F.col("m.role").alias("kind"), F.length(X.text_or_empty(F.col("m.content"))).alias("len"))
    return each.union(df.select(F.lit("total"), X.total_length(F.col("messages"))))


def length_profile(lengths: DataFrame) -> DataFrame:
    """(kind, n, min, p10, median, p90, max): percentiles by index n / 10, n / 2, 9 n / 10 of the sorted values, from 0.

    Exact, and no kind is sorted: lengths are counted first, and the counts summed up in order.
    """
    c = lengths.groupBy("kind", "len").agg(F.count("*").alias("c"))
    c = c.withColumns({"upto": F.sum("c").over(Window.partitionBy("kind").orderBy("len")), "n": F.sum("c").over(Window.partitionBy("kind"))})
    at = {"p10": "n div 10", "median": "n div 2", "p90": "9 * n div 10"}
    return c.groupBy("kind").agg(F.max("n").alias("n"), F.min("len").alias("min"), *(F.expr(f"min(case when upto > {k} then len end)").alias(name) for name, k in at.items()), F.max("len").alias("max"))


def over_limit(df: DataFrame, most: int = rules.MAX_TOTAL) -> DataFrame:
    """(over, pct); pct is null for no rows."""
    n = F.count_if(X.total_length(F.col("messages")) > most)
    return df.agg(n.alias("over"), F.round(100 * n / F.nullif(F.count("*"), F.lit(0)), 4).alias("pct"))


def duplicates(df: DataFrame) -> DataFrame:
    """(n, kinds, dups) by fingerprint of the first assistant message; kinds are counted by groups, not in one set."""
    return df.groupBy(X.answer_fingerprint(F.col("messages")).alias("f")).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("kinds"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("dups"))


def verdict(df: DataFrame) -> DataFrame:
    """(total, clean, rejected, dups, verdict); fails at 1 % rejected or more. No rows give a null verdict."""
    gates = gated(df).agg(F.count("*").alias("total"), F.count_if(F.col("gate").isNull()).alias("clean"))
    x = gates.crossJoin(F.broadcast(duplicates(df).select("dups"))).withColumn("rejected", F.col("total") - F.col("clean"))  # one row each
    said = (
        F.when(F.col("total") == 0, F.lit(None))
        .when((F.col("rejected") == 0) & (F.col("dups") == 0), F.lit("PASS"))
        .when(F.col("rejected") == 0, F.lit("PASS with duplicates"))
        .when(F.col("rejected") * 100 < F.col("total"), F.lit("PASS below 1 % rejected"))
        .otherwise(F.lit("FAIL"))
    )
    return x.select("total", "clean", "rejected", "dups", said.alias("verdict"))


def combined(parts: DataFrame) -> DataFrame:
    """Audit results of several files (file, total, clean, rejected, dups) with a line for all (file null) and pct clean."""
    return parts.rollup("file").agg(*(F.sum(c).alias(c) for c in ("total", "clean", "rejected", "dups"))).withColumn("pct", F.round(100 * F.col("clean") / F.nullif(F.col("total"), F.lit(0)), 4))


def audit_result(df: DataFrame, file: str) -> DataFrame:
    """One row: file, total, clean, rejected, dups, and rejections by gate as a map."""
    counts = first_failures(df).where("gate <> 'clean'").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gate", "n")))).alias("rejections"))
    return verdict(df).crossJoin(counts).select(F.lit(file).alias("file"), "total", "clean", "rejected", "dups", "rejections")  # one row each


def samples(df: DataFrame, key: str, n: int = 10, seed: int = 42) -> DataFrame:
    return shuffled_cap(df, n, key, seed)


def previews(df: DataFrame) -> DataFrame:
    """df with the beginnings of its first system, user and assistant message, or N/A."""
    return df.withColumns({role: F.coalesce(X.prefix(X.first_content(F.col("messages"), role), n), F.lit("N/A")) for role, n in (("system", 60), ("user", 120), ("assistant", 120))})


def first_rejections(df: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    return gated(df).where("gate is not null").orderBy(*order).select(*order, "gate", "detail").limit(n)


def preflight_report(train: DataFrame, eval_: DataFrame, least: int = 1000) -> DataFrame:
    """One row: train_count, eval_count, system_prompt_diversity, enough (are there `least` training rows)."""
    n = train.agg(F.count("*").alias("train_count")).crossJoin(eval_.agg(F.count("*").alias("eval_count"))).crossJoin(system_prompt_kinds(train))  # one row each
    return n.select("train_count", "eval_count", F.col("prompts").alias("system_prompt_diversity"), (F.col("train_count") >= least).alias("enough"))


def preflight(train: DataFrame, eval_: DataFrame, least: int = 1000) -> dict[str, int]:
    """The report's values; ValueError if there are too few training rows."""
    r = preflight_report(train, eval_, least).first().asDict()
    if not r.pop("enough"):
        raise ValueError(f"{r['train_count']} training rows; {least} are needed")
    return r
