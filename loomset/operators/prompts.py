"""From failures to inference requests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import rules
from loomset.functions import text as X


def filled(template: str, fields: dict[str, Column]) -> Column:
    """The template with {fields} put in; a value's own braces mean nothing."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(fields[p] if k % 2 else F.lit(p) for k, p in enumerate(parts) if p))


def prompt(task: Column, repair: Column | None = None, templates: dict[str, str] = rules.TEMPLATES) -> Column:
    """The request for a task, from a unified failure's columns; texts are cut to their limits in characters."""
    fields = {c: F.col(c) for c in ("source_model", "vertical", "failure_class")}
    fields |= {
        "errors": X.joined(F.col("errors"), "; ", "none reported"),
        "user_prompt": X.prefix(F.col("user_prompt"), rules.PROMPT_CUT),
        "model_output": X.prefix(F.col("model_output"), rules.OUTPUT_CUT),
        "repair_output": X.prefix(F.lit("") if repair is None else X.text_or_empty(repair), rules.REPAIR_CUT),
    }
    out = None
    for name, template in templates.items():
        out = F.when(task == name, filled(template, fields)) if out is None else out.when(task == name, filled(template, fields))
    return out


def wanted_tasks(requested: list[str], known: list[str] = rules.TASKS) -> list[str]:
    """Requested tasks that are known, in canonical order; compare only with repair. ValueError if none is left."""
    out = [t for t in known if t in requested]
    if "repair" not in out:
        out = [t for t in out if t != "compare"]
    if not out:
        raise ValueError(f"none of the tasks {requested} is known")
    return out


def task_rows(failures: DataFrame, tasks: list[str] = rules.TASKS) -> DataFrame:
    """A row for each failure with a prompt, and each task in order (task_ord from 0)."""
    return failures.where("user_prompt <> ''").select("*", F.posexplode(F.array(*map(F.lit, tasks))).alias("task_ord", "task"))
