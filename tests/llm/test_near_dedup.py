import random
import re

import numpy as np

from conftest import rows_of
from loomset.llm import near_dedup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return sorted(((i, len(sets[i]), find(i), find(i) == i) for i in ids), key=repr)


def family(r, n, words=60, change=3):
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        t = list(base)
        for _ in range(r.randrange(change + 1)):
            t[r.randrange(words)] = f"x{r.randrange(10**6)}"
        yield " ".join(t)


def test_against_brute_force(spark):
    r = random.Random(3)
    texts = [t for _ in range(12) for t in family(r, 8)] + ["", None, " \t ", "one", "One", "two words", "a b c d", "A b  c d", "A b c e"]
    texts += [texts[5], texts[5], "Äb c d e", "äb c d e"]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4)
    assert rows_of(got) == brute(rows, 4)


def test_large_groups_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "GROUP", 20)
    monkeypatch.setattr(N, "BLOCK", 10)
    monkeypatch.setattr(N, "LEADERS", 2)
    monkeypatch.setattr(N, "BUCKET", 8)
    r = random.Random(4)
    texts = list(family(r, 150, words=50, change=5)) + [t for _ in range(5) for t in family(r, 6)]
    rows = list(enumerate(texts))
    assert rows_of(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4)) == brute(rows, 4)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, "same text as the other one", 1, "z"), (1, "same text as the other one", 2, "z"), (2, "same text as the other one", 3, None), (2, "same text as the other one", 3, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long, kept string")
    got = rows_of(N.near_duplicates(df))
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)], key=repr)


def test_empty(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_min_and_max_estimate_similarity():
    r = np.random.default_rng(1)
    x = np.unique(r.integers(0, 1 << 63, 3000, dtype=np.uint64))
    a, b = x[:2000], x[500:2500]
    sig = N.signatures([a, b])
    assert sig.shape == (2, 2 * N.PERMUTATIONS)
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.15
