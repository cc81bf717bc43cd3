import json

import pytest

from conftest import rows_of
from loomset.sources import records as R


@pytest.fixture
def lines(tmp_path):
    good = {"id": "a", "instruction": "do", "output": "ok", "source": "x_y_z_w"}
    (tmp_path / "deep").mkdir()
    (tmp_path / "shard_2.jsonl").write_text("\n" + json.dumps(good) + "\n{broken\n[1, 2]\n   " + json.dumps(good | {"id": None}) + "  \n\n")
    (tmp_path / "deep" / "shard_1.jsonl").write_text(json.dumps(good | {"id": "b"}))
    (tmp_path / "other.jsonl").write_text("\n\n")
    return tmp_path


def test_lenient_keeps_places_and_quarantines(spark, lines):
    ok, bad = R.read_lenient(spark, f"{lines}/shard_2.jsonl", R.FAILURE)
    assert rows_of(ok, "id", "line_no") == sorted([("a", 2), (None, 5)], key=repr)
    assert rows_of(bad, "line_no", "line") == [(3, "{broken"), (4, "[1, 2]")]


def test_blank_file(spark, lines):
    ok, bad = R.read_lenient(spark, f"{lines}/other.jsonl", R.FAILURE)
    assert ok.count() == bad.count() == 0


def test_line_numbers_across_splits(spark, tmp_path):
    """Files of several splits, with line ends of each kind."""
    (tmp_path / "in").mkdir()
    want = []
    for name, end, n in (("a", "\n", 400), ("b", "\r\n", 300), ("c", "\r", 1), ("d", "\n", 0)):
        rows = [f"{name} {i} " + "x" * (i % 40) if i % 7 else "" for i in range(n)]
        (tmp_path / "in" / f"{name}.txt").write_bytes("".join(r + end for r in rows).encode())
        want += [(f"{name}.txt", i + 1, r) for i, r in enumerate(rows)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = R.numbered_lines(spark, str(tmp_path / "in"))
        assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 5
        assert sorted((r.source_path.rsplit("/", 1)[1], r.line_no, r.line) for r in got.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_numbers_through_a_folder(spark, tmp_path):
    """Files of a folder in order of their names, also when they are split, and folders apart from each other."""
    want = []
    for part in (0, 1):
        (tmp_path / f"part={part}").mkdir()
        n = 0
        for k, size in enumerate((90, 0, 3, 40)):
            rows = [f"{part} {k} {i} " + "x" * (i % 30) if i % 7 else "" for i in range(size)]
            (tmp_path / f"part={part}" / f"part-{k:05}.txt").write_text("".join(r + "\n" for r in rows))
            want += [(f"part={part}", n + i + 1, r) for i, r in enumerate(rows)]
            n += size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = R.numbered_lines(spark, str(tmp_path), folders=True).collect()
        assert sorted((r.source_path.rsplit("/", 1)[1], r.line_no, r.line) for r in got) == sorted(want)
        counts = rows_of(R.line_counts(spark, str(tmp_path), folders=True))
        assert [(p.rsplit("/", 1)[1], n) for p, n in counts] == [(f"part={k}", sum(p == f"part={k}" and r != "" for p, _, r in want)) for k in (0, 1)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 16 partitions, none of them joined again."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _by_sql(spark, name, written):
    """Rows of a catalog query as in SQL, of lines that lie in more files than parts."""
    import duckdb

    from conftest import SF
    from loomset.plans import catalog

    sql, df = catalog.ORACLES[name], catalog.QUERIES[name](spark, SF)
    files = [len(list(p.glob("part=*/*.txt"))) for p in written()]
    assert files and min(files) > 8, files
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cols = ", ".join(df.columns)
    assert rows_of(df) == sorted(c.sql(f"SELECT {cols} FROM ({sql})").fetchall(), key=repr)


@pytest.fixture
def written(spark):
    """The folders of lines that a test wrote."""
    from pathlib import Path

    from loomset.scratch import shared_dir

    shared = Path(shared_dir(spark).removeprefix("file://"))
    before = set(shared.glob("json-lines-*"))
    return lambda: set(shared.glob("json-lines-*")) - before


@pytest.mark.parametrize("name", ["jsonl_lenient_scan", "jsonl_audit", "jsonl_parse_errors", "jsonl_line_counts", "jsonl_quarantine", "jsonl_skipping"])
def test_a_part_is_no_single_task(spark, many_partitions, written, name):
    _by_sql(spark, name, written)


@pytest.mark.parametrize("name", ["jsonl_line_counts", "jsonl_quarantine", "jsonl_skipping"])
def test_tasks_follow_the_text(spark, monkeypatch, written, name):
    """With four shuffle partitions, as the session has them."""
    from loomset.plans import catalog

    monkeypatch.setattr(catalog, "SHARE", 16 << 10, raising=False)
    _by_sql(spark, name, written)


def test_discover(spark, lines):
    deep = R.discover(spark, str(lines))
    assert [p.rsplit("/", 1)[1] for (p,) in rows_of(deep, "path")] == ["shard_1.jsonl", "shard_2.jsonl"]
    assert R.discover(spark, str(lines), "*.jsonl", recursive=False).count() == 2
    assert R.discover(spark, f"{lines}/none").count() == 0
    assert all(len(h) == 64 for (h,) in rows_of(deep, "sha256"))
    with pytest.raises(FileNotFoundError):
        R.require(spark, str(lines), f"{lines}/none")


def test_skipping_and_strict(spark, lines):
    assert R.read_skipping(spark, f"{lines}/shard_2.jsonl", R.FAILURE).select("id", "instruction").where("instruction is not null").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        R.read_strict(spark, f"{lines}/shard_2.jsonl", R.FAILURE).collect()


def test_training_needs_two_messages(spark, tmp_path):
    m = [{"role": "user", "content": "x"}, {"role": "assistant", "content": "y"}]
    (tmp_path / "good.jsonl").write_text(json.dumps({"messages": m}))
    (tmp_path / "bad.jsonl").write_text(json.dumps({"messages": m[:1]}))
    assert R.read_training(spark, f"{tmp_path}/good.jsonl").count() == 1
    with pytest.raises(Exception, match="fewer than two"):
        R.read_training(spark, f"{tmp_path}/bad.jsonl").collect()


def test_audit_forms(spark, tmp_path):
    m = [{"role": "user", "content": "x"}]
    (tmp_path / "a.jsonl").write_text("\n".join([json.dumps({"messages": m}), json.dumps({"messages": "x"}), "{}", "", "{bad", json.dumps({"messages": None})]))
    assert [(n, f) for n, f in rows_of(R.read_for_audit(spark, f"{tmp_path}/a.jsonl"), "line_no", "form")][:4] == [(1, "list"), (2, "not a list"), (3, "absent"), (5, "bad")]


def test_line_counts(spark, lines):
    got = {p.rsplit("/", 1)[1]: n for p, n in rows_of(R.line_counts(spark, [f"{lines}/shard_2.jsonl", f"{lines}/deep/shard_1.jsonl"]))}
    assert got == {"shard_2.jsonl": 4, "shard_1.jsonl": 1}
