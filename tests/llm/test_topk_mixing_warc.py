import base64
import fractions
import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from loomset.llm import mixing, topk, warc

# top-k


def brute_top(vectors, queries, k):
    def q(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(64 * fractions.Fraction(x)) for x in v]

    cand = [(i, q(v)) for i, v in vectors if i is not None and q(v) is not None]
    out = []
    for i, v in queries:
        v = q(v)
        if i is None or v is None:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in cand if j != i)[:k]  # noqa: B905
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("dims", [1, 3, 70])
def test_top_k(spark, monkeypatch, dims):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 10)
    r = random.Random(dims)
    vectors = [(i, [float(np.float32(r.choice([-1, -0.5, 0.01, 0.5, r.gauss(0, 1)]))) for _ in range(dims)]) for i in range(150)]
    vectors += [(500, None), (501, [None] * dims), (502, [math.nan] * dims), (503, [math.inf] * dims), (None, [1.0] * dims), (504, [0.0] * dims), (505, vectors[3][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 7)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == brute_top(vectors, [v for v in vectors if v[0] is not None and v[0] % 10 == 0], 7)


def test_top_k_stops_early():
    r = np.random.default_rng(2)
    x = r.integers(-5, 5, (5000, 3)).astype(np.float64)
    x[17] = [900, 900, 900]
    lists = topk.Lists(np.arange(5000), x)
    ((_, ids, score),) = lists.search(np.array([-1]), np.array([[10.0, 10, 10]]), 1)
    assert (ids[0], score[0]) == (17, 27000) and lists.stopped == 1 and lists.scored < 100
    # a kth score known from elsewhere leaves the block out
    lists.scored = 0
    ((_, ids, _),) = lists.search(np.array([-1]), np.array([[10.0, 10, 10]]), 1, np.array([27001.0]))
    assert len(ids) == 0 and lists.scored == 0


def test_bound_reads_no_more_than_it_must():
    """The bound that the plan stops at holds for all that is not met, and one step less would not do."""
    r = np.random.default_rng(3)
    x, q = np.floor(r.normal(0, 20, (3000, 4))), np.floor(r.normal(0, 20, (50, 4)))
    lists = topk.Lists(np.arange(3000), x)
    scores = q @ x.T
    least = np.sort(scores, axis=1)[:, -5]
    depth, stops = lists.plan(q, least)
    met = lists.met(q, depth)
    for k in range(50):
        if stops[k]:
            assert scores[k][~met[k]].max() < least[k] and (depth[k] < 3000).all()


def test_top_k_of_large_numbers(spark):
    vectors = [(i, [float(v), float(i % 7)]) for i, v in enumerate([1e3, -1e3, 2.0**50, 2.0**51 + 2, 1e17, 1e150, -1e150, 1e306, 1.7e308, 3.5])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    most = (1 << 63) - 1
    want = [(i, r, j, max(-most - 1, min(most, s))) for i, r, j, s in brute_top(vectors, vectors, 20)]
    got = topk.top_k(df, df).collect()
    scores = {(i, j): s for i, _, j, s in want}
    assert len(got) == 90 and all(scores[r.query_id, r.vec_id] == r.score for r in got)
    for i in range(10):
        mine = sorted((r["rank"], -r.score, r.vec_id) for r in got if r.query_id == i)
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_top_k_of_repeated_queries(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 5.0]), (3, [5.0, 3.0]), (3, [5.0, 3.0])]
    df = spark.createDataFrame([(a, b, 0, "x") for a, b in rows], "vec_id long, embedding array<float>, rank int, key string")
    got = rows_of(topk.top_k(df, df.where("vec_id = 1"), 3, 1), "rank", "vec_id", "score")
    assert got == sorted([(1, 3, 5), (2, 3, 5), (3, 2, 3), (1, 2, 5), (2, 3, 3), (3, 3, 3)], key=repr)


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, df).count() == 0


# mixing


def test_targets_reshare_the_excess(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 500), (None, 300), ("d", 0)]
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    order = ["a", "b", "c", "d", None]
    w = dict(zip(order, [3, 1, 2, 3, 1], strict=True))
    want, left, open_ = {}, 1.5 * 1810, set(order)
    while True:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if w[s] * level > 2 * dict(sizes)[s]]
        if not full:
            want |= {s: w[s] * level for s in open_}
            break
        for s in full:
            want[s] = 2.0 * dict(sizes)[s]
            left -= want[s]
            open_.remove(s)
    assert {s: pytest.approx(t) for s, t in want.items()} == {s: got[s][1] for s in order}


def test_mix(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["a", "a", "a", "b", None, "é"]), r.choice([None, "", "x"]) if i % 9 == 0 else "w " * r.randrange(1, 40), i) for i in range(3000)] + [(None, "b", "one two", 1), (5, "b", "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size long")
    got = mixing.mix_sources(df)
    again = mixing.mix_sources(df.repartition(11))
    assert rows_of(got) == rows_of(again)
    assert got.count() == 3002 and got.where("taken < 0 or taken > 2 * size").count() == 0
    for row in got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.sum("size").alias("s"), F.max("source_size").alias("n")).collect():
        assert row.t == math.floor(row.g) and row.s == row.n
    at = [x[0] for x in got.select("position").collect()]
    assert at == sorted(at, key=lambda x: (x is None, x))
    # each taken pass has a position, and nothing else has
    assert got.where("(taken > 0) <> (position is not null) or (taken > size) <> (again is not null) or again <= position").count() == 0
    order = mixing.training_order(got)
    assert order.agg(F.sum("words")).first()[0] == got.agg(F.sum("taken")).first()[0]
    at = [x[0] for x in order.select("at").collect()]
    assert at == sorted(at) and len(at) == got.where("position is not null").count() + got.where("again is not null").count()


def test_schedule_is_inverted(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], "w " * 10) for i in range(3000)], "doc_id long, source string, text string")
    # targets 20000, 25000 / 3 and 50000 / 3; at a quarter of the time a has given 0.34375 of its own, b 0.25, c 0.15625
    at = 20000 * 0.34375 + 25000 / 3 * 0.25 + 50000 / 3 * 0.15625
    early = dict(tuple(r) for r in mixing.mix_sources(df).where(F.col("position") < at).groupBy("source").count().collect())
    assert early == {"a": pytest.approx(687, abs=2), "b": pytest.approx(208, abs=2), "c": pytest.approx(260, abs=2)}


def test_mix_empty(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
    one = mixing.mix_sources(spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")).first()
    assert (one["size"], one.target, one.taken) == (0, 0.0, 0)


# WARC


def brute_pages(rows, least):
    low = {}
    for i, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            low[h or ""] = min(i, low.get(h or "", i))
    out = []
    for i, h in rows:
        b = (h or "").encode()
        first = low.get(h or "")
        revisit = i is not None and first is not None and i != first
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "segment"), [(0, 1 << 20), (0, 100), (5, 37)])
def test_round_trip(spark, least, segment):
    r = random.Random(segment)
    pages = [(i, r.choice(["", None, "WARC/1.1\r\n\r\n", "é" * 50, "abc", "x" * 9000, "\r\n\r\n" * 40, "0\r\n\r\n", str(i) * 50])) for i in range(80)] + [(None, "abc"), (None, "zz"), (3, "abc"), (3, "abc")]
    df = spark.createDataFrame([(i, None if k % 3 else f"http://x/{k}\r\ny", h, "clash") for k, (i, h) in enumerate(pages)], "page_id long, url string, html string, status string")
    assert rows_of(warc.page_records(df, least, segment)) == brute_pages(pages, least)


def test_archives_are_gzip_by_record_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 50_000)
    pages = spark.createDataFrame([(i, f"http://x/{i % 30}", "y" * 4000 + str(i % 30)) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "w"), segment=1500)
    files = sorted((tmp_path / "w").glob("part-*"))
    assert len(files) > 5
    heads = []
    for f in files:
        data = f.read_bytes()
        assert gzip.decompress(data).startswith(b"WARC/1.1")
        parts = list(warc.members(data, step=100))
        assert all(len(list(warc.parse(p))) == 1 for p in parts) and len(parts) <= 9
        heads += [h for p in parts for h, _ in warc.parse(p)]
    ids = {h["warc-record-id"]: h for h in heads}
    assert len(ids) == len(heads)
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert len(revisits) == 30 and all(ids[h["warc-refers-to"]]["x-page-id"] == h["x-refers-to-page-id"] for h in revisits)


def test_torn_archives_are_told(spark, tmp_path):
    pages = spark.createDataFrame([(i, None, "z" * 50) for i in range(3)], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "w"))
    (f,) = (tmp_path / "w").glob("part-*")
    data = f.read_bytes()
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.gz").write_bytes(data[:-20])
    (tmp_path / "x" / "b.warc").write_bytes(gzip.decompress(data)[:-30])
    (tmp_path / "x" / "c.warc").write_bytes(b"no archive")
    got = rows_of(warc.read_warc(spark, str(tmp_path / "x")), "kind", "status")
    assert sorted(k for k, _ in got) == ["response"] * 2 + ["revisit"] * 2 + ["torn"] * 3
    assert all(s.startswith("broken: ") for k, s in got if k == "torn")


def test_empty_table(spark):
    assert warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_broken_records_are_told_not_dropped():
    part = lambda n, b, total=None: {"number": n, "block": b, "total": total}
    assert warc.assembled([part(2, b"b", 2), part(1, b"a")]) == (b"ab", "ok")
    assert warc.assembled([part(1, b"a"), part(3, b"b", 2)])[1].startswith("broken: segments")
    assert warc.assembled([part(1, b"a"), part(2, b"b", 5)])[1] == "broken: total length differs"
    assert warc.assembled([part(1, b"a")])[1] == "broken: no total length"
    assert warc.unchunked(warc.chunked(b"x" * 20000, 7)) == b"x" * 20000 and warc.unchunked(b"3;q=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    for bad in (b"5\r\nabc", b"3\r\nabc", b"zz\r\n", b""):
        with pytest.raises(ValueError):
            warc.unchunked(bad)
