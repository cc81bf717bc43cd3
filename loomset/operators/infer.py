"""Inference as a partition-parallel map with a pluggable backend: the one place where Python runs on executors."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import rules
from loomset.functions import text as X
from loomset.operators.prompts import prompt, task_rows, wanted_tasks

#: A backend is made once for each task; called with a request it returns the answer, or None.
Backend = Callable[[str], str | None]


def with_retries(call: Backend, tries: int = 3, first_wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Backend:
    """Waits 1 s, 2 s, ... between tries; an HTTP error other than 503 is final, and so is the last try."""

    def run(request: str) -> str | None:
        for k in range(tries):
            try:
                return call(request)
            except urllib.error.HTTPError as e:
                if e.code != 503:
                    return None
            except Exception:
                pass
            if k + 1 < tries:
                sleep(first_wait * 2**k)
        return None

    return run


def http_backend(url: str, temperature: float = 0.6, max_tokens: int = 2048, timeout: float = 300) -> Backend:
    """A chat-completions endpoint."""

    def call(request: str) -> str | None:
        body = {"messages": [{"role": "system", "content": rules.SYSTEM_PROMPT}, {"role": "user", "content": request}], "temperature": temperature, "max_tokens": max_tokens, "stream": False}
        q = urllib.request.Request(f"{url}/v1/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(q, timeout=timeout) as r:
            return json.load(r)["choices"][0]["message"]["content"]

    return with_retries(call)


def healthy(url: str, timeout: float = 5) -> bool:
    """Whether the endpoint's status is ok."""
    try:
        with urllib.request.urlopen(f"{url}/health", timeout=timeout) as r:
            return json.load(r).get("status") == "ok"
    except Exception:
        return False


def infer(requests: DataFrame, make: Callable[[], Backend], request_col: str = "request") -> DataFrame:
    """requests with response (null: failed) and latency_ms. Write the result before using it twice: each use asks again."""
    schema = T.StructType([*requests.schema.fields]).add("response", "string").add("latency_ms", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = None
        for batch in batches:
            backend = backend or make()
            answers, took = [], []
            for r in batch.column(batch.schema.get_field_index(request_col)).to_pylist():
                t = time.monotonic()
                answers.append(backend(r))
                took.append(int(1000 * (time.monotonic() - t)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string()), pa.array(took, pa.int64())], [*batch.schema.names, "response", "latency_ms"])

    return requests.mapInArrow(run, schema)


def stub_response(request: Column, fail_every: int = 7) -> Column:
    """A deterministic answer as a plain expression: null for one request in fail_every."""
    h = F.md5(request)
    return F.when(F.conv(F.substring(h, 1, 6), 16, 10).cast("long") % fail_every != 0, F.concat(F.lit("root cause, step, check, evidence, score: "), F.upper(h), F.lit(" and the confidence is stated")))


Answer = Callable[[DataFrame], DataFrame]
#: Writes answers to a stage's requests and gives them back as they were written.
Keep = Callable[[DataFrame, str], DataFrame]


def live_pairs(failures: DataFrame, answer: Answer, tasks: list[str] = rules.TASKS, model: str = "local", temperature: float = 0.6, keep: Keep | None = None, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Pairs and error rows of all tasks. answer adds response to rows with request; compare is asked after repair.

    A failed request gives an error row; a failed repair leaves compare with an empty output B. carry: further columns of
    failures that both results keep. keep(requests, stage) must answer and write the requests of a stage, `first` or `compare`,
    so that each is asked once, and compare is told the repair that is stored. Without it, answer must be a plain expression,
    which gives the same each time it is computed.
    """
    ask = keep or (lambda requests, _stage: answer(requests))
    rows = task_rows(failures, wanted_tasks(tasks))
    first = ask(rows.where("task <> 'compare'").withColumn("request", prompt(F.col("task"))), "first")
    both = first
    if "compare" in wanted_tasks(tasks):
        key = ["id", *carry]
        repaired = first.where("task = 'repair'").select(*key, F.col("response").alias("repair_output"))
        late = rows.where("task = 'compare'").join(repaired, key, "left")
        second = ask(late.withColumn("request", prompt(F.col("task"), F.col("repair_output"))).drop("repair_output"), "compare")
        both = first.unionByName(second, allowMissingColumns=True)
    messages = F.array(X.message("system", F.lit(rules.SYSTEM_PROMPT)), X.message("user", F.col("request")), X.message("assistant", F.col("response")))
    latency = F.col("latency_ms") if "latency_ms" in both.columns else F.lit(None).cast("long")
    meta = F.struct("failure_class", "vertical", "source_model", F.lit(model).alias("inference_model"), F.lit(temperature).alias("temperature"), latency.alias("latency_ms"))
    pairs = both.where("response is not null").select("id", *carry, "task", "task_ord", messages.alias("messages"), meta.alias("metadata"))
    errors = both.where("response is null").select("id", *carry, "task", F.lit("inference failed").alias("error"))
    return pairs, errors
