import json

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from loomset.operators import infer, state
from loomset.plans import curate
from loomset.streaming import ingest


def _write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(map(json.dumps, rows)))


def _answer(df):
    return df.withColumn("response", infer.stub_response(F.col("request")))


def _failure(i):
    return {"id": f"f{i}", "failure_class": "drift", "context": {"user_prompt": f"ask {i}", "model_output": "bad"}, "failure_details": {"errors": ["e"]}}


def test_two_runs(spark, tmp_path):
    fail, back, out = tmp_path / "fail", tmp_path / "back", tmp_path / "out"
    _write(fail / "x" / "shard_1.jsonl", [_failure(i) for i in range(4)])
    long = "step by step, the root cause is fixed and each check is stated in full"
    _write(back / "b.jsonl", [{"id": f"b{i}", "source": "selfheal_repair_x", "instruction": f"i {i}", "output": f"{long} {i}"} for i in range(3)])
    run = lambda: curate.run(spark, str(fail), str(back), str(out), _answer)
    first = run()
    assert first["shards"] == 2 and first["raw"] + first["errors"] == 4 * 5 + 3 and first["vetted"] > 0
    cells = spark.read.parquet(f"{out}/cells").count()
    assert cells == first["cells"]
    assert run() == {"shards": 0, "records": 0, "raw": 0, "vetted": 0, "rejected": 0, "cells": 0, "errors": 0}
    metrics = {r.shard.rsplit("/", 1)[1]: r for r in state.load(spark, f"{out}/state", "metrics").collect()}
    one, two = metrics["shard_1.jsonl"], metrics["b.jsonl"]
    assert (one.records, two.records, two.raw, two.errors) == (4, 3, 3, 0) and one.raw + one.errors == 20
    assert one.vetted + one.rejected == one.raw and state.load(spark, f"{out}/state", "errors").count() == one.errors
    # an edited shard is processed again, a copy under a new name too
    _write(back / "b.jsonl", [{"id": "b9", "source": "x", "instruction": "i", "output": f"{long} 9"}])
    assert run()["shards"] == 1
    assert state.load(spark, f"{out}/state", "shards").count() == 3
    totals = state.totals(state.load(spark, f"{out}/state", "metrics")).first()
    assert totals["raw"] == first["raw"] + 1


def _counting(path):
    """A backend of which each request leaves a line in a file."""

    def make():
        def call(request):
            with open(path, "a") as f:
                f.write("x\n")
            return None if len(request) % 5 == 0 else f"root cause, a step to fix it, guardrail check, positive evidence, score {request[-60:]}"

        return call

    return lambda df: infer.infer(df, make)


def _results(spark, out):
    vetted = rows_of(spark.read.parquet(f"{out}/vetted"), "id", "task", "score", "reason")
    cells = rows_of(spark.read.parquet(f"{out}/cells"), "cell_id", "verification_score")
    metrics = rows_of(state.load(spark, f"{out}/state", "metrics"), *state.COUNTERS)
    return vetted, cells, metrics, rows_of(state.load(spark, f"{out}/state", "errors"), "id", "task"), rows_of(state.load(spark, f"{out}/state", "fingerprints"), "fingerprint")


def test_requests_are_asked_once_and_reruns_agree(spark, tmp_path, monkeypatch):
    fail, back = tmp_path / "fail", tmp_path / "back"
    _write(fail / "shard_1.jsonl", [_failure(i) for i in range(3)] + [{"id": "no prompt"}])
    (fail / "shard_1.jsonl").open("a").write("\n{broken")
    _write(back / "b.jsonl", [{"id": f"b{i}", "source": "selfheal_repair_x", "instruction": f"i {i}", "output": f"step by step, the root cause is fixed and stated in full {i % 2}"} for i in range(3)])
    go = lambda out, asked: curate.run(spark, str(fail), str(back), str(out), _counting(asked))
    got = go(tmp_path / "clean", tmp_path / "asked")
    assert len((tmp_path / "asked").read_text().split()) == 15 and got["records"] == 7 and got["raw"] + got["errors"] == 18
    assert [r.line for r in spark.read.parquet(str(tmp_path / "clean/quarantine")).select("line").collect()] == ["{broken"]
    want = _results(spark, tmp_path / "clean")
    write, append = state.write_output, state.append
    for name in ("answers/compare", "state shards"):
        out, asked = tmp_path / name.replace(" ", "-").replace("/", "-"), tmp_path / f"asked {name.replace('/', ' ')}"

        def dying_write(df, path, *rest, name=name):
            if name in path:
                raise KeyboardInterrupt
            write(df, path, *rest)

        def dying_append(rows, path, table, name=name):
            if name == f"state {table}":
                raise KeyboardInterrupt
            append(rows, path, table)

        with monkeypatch.context() as m:
            m.setattr(state, "write_output", dying_write)
            m.setattr(state, "append", dying_append)
            with pytest.raises(KeyboardInterrupt):
                go(out, asked)
        assert go(out, asked) == got
        assert _results(spark, out) == want
        assert len(asked.read_text().split()) == 15


def test_tasks_are_checked(spark, tmp_path):
    _write(tmp_path / "f" / "shard_1.jsonl", [_failure(1)])
    run = lambda tasks: curate.run(spark, str(tmp_path / "f"), str(tmp_path / "none"), str(tmp_path / "o"), _answer, tasks)
    with pytest.raises(ValueError):
        run(["compare", "unknown"])
    got = run(["unknown", "detect", "compare"])
    assert got["raw"] + got["errors"] == 1


def test_failures_wait_without_a_model(spark, tmp_path):
    _write(tmp_path / "f" / "shard_1.jsonl", [_failure(1)])
    assert curate.run(spark, str(tmp_path / "f"), str(tmp_path / "none"), str(tmp_path / "o"))["shards"] == 0
    assert curate.plan(spark, str(tmp_path / "f"), str(tmp_path / "none"), str(tmp_path / "o/state")).count() == 1


def test_output_is_replaced_by_partition(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "shard_key string, x int")
    state.write_output(df, str(tmp_path / "o"))
    state.write_output(df.where("shard_key = 'a'").withColumn("x", F.lit(5)), str(tmp_path / "o"))
    assert rows_of(spark.read.parquet(str(tmp_path / "o")), "shard_key", "x") == [("a", 5), ("b", 2)]


def test_stream(spark, tmp_path):
    _write(tmp_path / "in" / "a.jsonl", [_failure(i) for i in range(3)])
    seen = []
    (tmp_path / "in" / "a.jsonl").open("a").write("\n{broken\n\n")
    stream = ingest.read_stream(spark, str(tmp_path / "in"))
    bad = ingest.each_batch(stream, lambda df, _n: seen.extend(r.bad_line for r in df.where("bad_line is not null").collect()), str(tmp_path / "cp0"))
    bad.awaitTermination(60)
    assert seen == ["{broken"]
    seen.clear()
    stream = stream.where("bad_line is null")
    for want in (3, 5):
        ingest.each_batch(stream, lambda df, _n: seen.extend(r.id for r in df.select("id").collect()), str(tmp_path / "cp")).awaitTermination(60)
        assert len(seen) == want
        _write(tmp_path / "in" / "b.jsonl", [_failure(i) for i in range(7, 9)])


def test_stream_meets_the_state(spark, tmp_path):
    back, fail, out = tmp_path / "back", tmp_path / "fail", tmp_path / "out"
    fail.mkdir()
    long = "step by step, the root cause is fixed and each check is stated in full"
    record = lambda i: {"id": f"b{i}", "source": "selfheal_repair_x", "instruction": "i", "output": f"{long} {i}"}
    go = lambda: ingest.curated(spark, str(fail), str(back), str(out), None, str(tmp_path / "cp")).awaitTermination(120)
    _write(back / "a.jsonl", [record(1), record(2)])
    go()
    _write(back / "c.jsonl", [record(2), record(3)])
    go()
    go()
    assert rows_of(spark.read.parquet(f"{out}/vetted"), "id", "score") == [("b1", 70), ("b2", 60), ("b2", 70), ("b3", 70)]
    assert state.load(spark, f"{out}/state", "shards").count() == 2


def test_stream_distinct(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"fingerprint": "ab"[i % 2], "ts": "2024-01-01T00:00:00Z"} for i in range(6)]
    _write(tmp_path / "in" / "a.jsonl", rows)
    df = spark.readStream.schema("fingerprint string, ts timestamp").json(str(tmp_path / "in"))
    q = ingest.distinct_within(df, "fingerprint", "ts").writeStream.format("memory").queryName("distinct_rows").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("distinct_rows").count() == 2
