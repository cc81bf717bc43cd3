import hashlib
import random

import numpy as np
import pytest

from loomset.llm import suffix_dedup as S


def _gone(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((k, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + length] = True
    return texts, gone


def left_text(rows, length):
    """What is left of each text, without characters that are cut in part."""
    out = []
    for t, g in zip(*_gone(rows, length), strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[1], g.astype(int), [1]])))
        out.append("".join(t[a:b].decode(errors="ignore") for a, b in edge.reshape(-1, 2)))
    return out


def brute(rows, length):
    texts, gone = _gone(rows, length)
    out = []
    for (i, _), t, g in zip(rows, texts, gone, strict=True):
        starts = int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())
        out.append((i, len(t), int(g.sum()), starts, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~g])).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = S.remove_repeats(df, length).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out), key=repr)


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc\xff", bytes(range(97, 123))])
def test_suffix_array(alphabet):
    r = random.Random(1)
    for _ in range(40):
        t = bytes(r.choice(alphabet) for _ in range(r.randint(1, 300)))
        t += t[: len(t) // 2] + b"\xff" + t
        order = S.suffix_array(np.frombuffer(t, np.uint8), 40)
        assert sorted(order) == list(range(len(t)))
        keys = [t[i : i + 40] for i in order]
        assert keys == sorted(keys)


def texts(r, n=60):
    shared = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(30, 400))) for _ in range(6)]
    own = lambda: "".join(r.choice("abcdefghé ") for _ in range(r.randint(0, 300)))
    out = [own() + r.choice(shared) + own() + (r.choice(shared) if r.random() < 0.3 else "") for _ in range(n)]
    return out + [out[3], out[3], "x" * 700, "ab" * 300, None, "", "short"]


@pytest.mark.parametrize("length", [20, 200])
def test_against_brute_force(spark, length):
    rows = list(enumerate(texts(random.Random(length))))
    assert run(spark, rows, length) == brute(rows, length)


def test_large_groups_are_split_by_content(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 4)
    rows = list(enumerate(texts(random.Random(9), 40)))
    assert run(spark, rows, 200) == brute(rows, 200)


def test_repeated_rows_and_null_ids(spark):
    t = "".join(random.Random(2).choice("abcdefgh") for _ in range(500))
    rows = [(1, t), (1, t), (None, "z" + t), (None, None)]
    assert run(spark, rows, 200) == brute(rows, 200)


def test_clashing_names_and_long_texts(spark):
    r = random.Random(3)
    long = "".join(r.choice("abcdefgh ") for _ in range(1_500_000))
    rows = [(1, long, "a", 5, "k"), (2, "x" + long[700_000:700_300] + "y", "b", 6, None), (None, "short", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_bytes int, key string")
    out = S.remove_repeats(df, carry=["doc_id", "spans", "n_bytes", "key"])
    assert out.columns == ["doc_id", "key", "n_bytes", "n_removed", "spans", "kept", "text"]
    got = {x.doc_id: x for x in out.collect()}
    assert [(got[i].n_bytes, got[i].n_removed) for i in (1, 2, None)] == [(1_500_000, 300), (302, 300), (5, 0)]
    assert [(x.start, x.end) for x in got[1].spans] == [(700_000, 700_300)] and got[2].text == "xy"


def test_empty_and_text_without_cut_characters(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    a = "é" * 101  # 202 bytes of one repeated character: all strings repeat
    got = S.remove_repeats(spark.createDataFrame([(1, a), (2, "xé" + "abc" * 5)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in got} == {1: ("", 202), 2: ("xé" + "abc" * 5, 0)}
