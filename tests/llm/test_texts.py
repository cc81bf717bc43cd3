"""Decontamination, language models, classifiers, token counts and the pipeline."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF, rows_of
from loomset.llm import common, decontaminate, language, lm_score, near_dedup, quality, token_counts
from loomset.scratch import scratch, stash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

# decontamination


def brute_hits(docs, items, n=10):
    out = []
    cut = [(i, ALNUM.findall((t or "").translate(LOWER))) for i, t in items]
    for i, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, ids = set(), set()
        for item, x in cut:
            k = min(n, len(x))
            for a in range(len(x) - k + 1) if x else ():
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == x[a : a + k]:
                        hit.update(range(p, p + k))
                        if item is not None:
                            ids.add(str(item))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


#: Two words of 1,024 letters that a polynomial hash modulo 2^64 takes for one.
THUE = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
MORSE = THUE.translate(str.maketrans("ab", "ba"))


def test_words_that_fool_a_polynomial_hash(spark):
    words = common.Words(np.frombuffer(f"{THUE} {MORSE} {THUE}".encode(), np.uint8), np.array([0, 3 * 1024 + 2]))
    assert words.hash[0] == words.hash[2] != words.hash[1]
    docs = spark.createDataFrame([(2, THUE), (3, MORSE), (4, THUE)], "doc_id long, text string")
    got = decontaminate.contamination(docs, spark.createDataFrame([(1, MORSE)], "item_id long, text string"))
    assert rows_of(got, "doc_id", "n_hit") == [(2, 0), (3, 1), (4, 0)]
    train = {t for i, t in ((2, THUE), (3, MORSE), (4, THUE)) if zlib.crc32(str(i).encode()) % 5 != 1}
    assert rows_of(lm_score.lm_scores(docs), "doc_id", "n_known") == [(i, 1 + (t in train)) for i, t in ((2, THUE), (3, MORSE), (4, THUE))]
    assert rows_of(near_dedup.near_duplicates(docs), "doc_id", "component_id") == [(2, 2), (3, 3), (4, 2)]


def test_hash_of_words_tells_them_apart():
    r = random.Random(8)
    words = sorted({"".join(r.choice("abAB\0é") for _ in range(r.choice([1, 2, 3, 7, 8, 9, 16, 17, 40, 255, 256, 257, 600]))) for _ in range(5000)})
    b = "\n".join(words).encode()
    w = common.Words(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
    low = [x.translate(LOWER) for x in words]
    assert len(set(zip(w.hash.tolist(), low, strict=True))) == len(set(low)) == len(set(w.hash.tolist()))
    same = common.same_words(w, np.arange(len(words)), w, np.arange(len(words))[::-1].copy())
    assert same.tolist() == [a == b for a, b in zip(low, low[::-1], strict=True)]


def test_bytes_are_compared_where_hashes_agree(spark, monkeypatch):
    """With a hash of words that tells nothing apart but lengths, hits are the same."""
    rows, items = [(1, "aa bb cc dd"), (2, "aa bb xx dd"), (3, "zz bb cc")], [(1, "bb cc"), (2, "xx")]
    monkeypatch.setattr(common, "mix", lambda x: x * np.uint64(0) + np.uint64(1))
    w = decontaminate._words([t.encode() for _, t in rows])
    index = decontaminate.Index(np.array(["1", "2"], dtype=object), decontaminate._words([t.encode() for _, t in items]), 10, np.zeros(decontaminate.SLOTS, np.int64))
    at, k = index.hits(w)
    assert sorted((int(w.doc[p]), index.ids[index.item[j]]) for p, j in zip(at, k, strict=True)) == [(0, "1"), (1, "2"), (2, "1")]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontaminate, "PIECE", 1 << 16 if block > 60 else 7)
    r = random.Random(1)
    words = lambda n: [r.choice(["a", "B", "c9", "d", "é"]) for _ in range(n)]
    items = [(k, " ".join(words(r.choice([1, 3, 9, 10, 14, 30])))) for k in range(12)] + [(None, " ".join(words(12))), (50, None), (51, "?!"), (3, " ".join(words(11)))]
    docs = [(k, " ".join(words(r.randrange(60)))) for k in range(30)]
    docs += [(100 + k, "x, " + (t or "") + "-- y") for k, (_, t) in enumerate(items)] + [(5, None), (None, ""), (7, "é" * 30), (100, docs[0][1]), (100, docs[0][1])]
    got = decontaminate.contamination(spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, items int"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got.drop("items")) == brute_hits(docs, items)


def test_contamination_of_nothing(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert rows_of(decontaminate.contamination(docs, none).drop("items", "items_sha256")) == [(1, 2, 0, 0, False)]
    assert decontaminate.contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


# language-model scores


def counted(texts):
    b, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    u, n = np.unique(lm_score.grams(b, offs)[0], return_counts=True)
    out = []
    for d in range(lm_score.DEPTH + 1):
        a, i = np.unique(u & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        out.append((a, np.bincount(i, n).astype(int)))
    return out


def recursive(counts_of, context, depth, node):
    """Weighted log probability of a node by the definition, and of its own estimate."""
    a, b = counts_of[depth].get((context, node), (0, 0))
    own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    if depth == lm_score.DEPTH:
        return own
    below = sum(recursive(counts_of, c, depth + 1, node) for c, m in counts_of[depth + 1] if m == node and c & ((1 << 8 * depth) - 1) == context)
    return math.log(0.5) + np.logaddexp(own, below)


def test_tree_weighting_by_its_definition(monkeypatch):
    monkeypatch.setattr(lm_score, "DEPTH", 2)
    texts = [b"abracadabra", b"banana", b""]
    counts = counted(texts)
    table = []
    for g, n in counts:
        d = collections.defaultdict(lambda: [0, 0])
        for x, c in zip(g.tolist(), n.tolist(), strict=True):
            for j in range(8):
                d[(x >> 8, 1 << j | (x & 255) >> (8 - j))][x >> (7 - j) & 1] += c
        table.append({k: tuple(v) for k, v in d.items()})
    tree = lm_score._Tree([tuple(x) for x in counts])

    def mixed(context, node):
        """By the definition: weights of a path's estimates, deepest first."""
        path = [d for d in range(3) if (context & ((1 << 8 * d) - 1), node) in table[d]]
        p = None
        for d in reversed(path):
            c = context & ((1 << 8 * d) - 1)
            a, b = table[d][(c, node)]
            kt = (b + 0.5) / (a + b + 1)
            if p is None:
                p = kt
                continue
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            below = sum(recursive(table, k, d + 1, node) for k, m in table[d + 1] if m == node and k & ((1 << 8 * d) - 1) == c)
            share = math.exp(own - np.logaddexp(own, below))
            p = share * kt + (1 - share) * p
        return 0.5 if p is None else p

    for context in (b"ab", b"an", b"xy", b"\xffb"):
        c = int.from_bytes(context, "big")
        for byte in b"abnz\xff":
            want = sum(math.log10(q if byte >> (7 - j) & 1 else 1 - q) for j in range(8) for q in [mixed(c, 1 << j | byte >> (8 - j))])
            assert tree.log10(np.array([c << 8 | byte], np.uint64))[0] == pytest.approx(want, rel=1e-5)


def test_scores_are_a_distribution():
    model = lm_score.Model(counted([b"the cat sat on the mat", b"a dog", b""]))
    for context in (b"n the", b"zzzzz", b"\xff" * 5):
        g = np.array([int.from_bytes(context, "big") << 8 | k for k in range(256)], np.uint64)
        assert (10 ** model.tree.log10(g)).sum() == pytest.approx(1)


def test_lm_scores(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["the", "The", "cat", f"w{r.randrange(300)}"]) for _ in range(r.randrange(40)))) for i in range(300)] + [(1000, None), (1001, ""), (7, "the the"), (7, "the the"), (None, "null id")]
    got = collections.defaultdict(list)
    for x in lm_score.lm_scores(spark.createDataFrame([(a, b, 0.0) for a, b in rows], "doc_id long, text string, score double")).collect():
        got[x.doc_id].append(x)
    tokens = [(a, [*SPACED.findall((t or "").translate(LOWER)), None]) for a, t in rows]
    c = collections.Counter()
    for a, w in tokens:
        if a is not None and zlib.crc32(str(a).encode()) % 5 != 1:
            c.update(w)
    n, v = sum(c.values()), len(c)
    assert sum(map(len, got.values())) == len(rows)
    for a, w in tokens:
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        held = a is None or zlib.crc32(str(a).encode()) % 5 == 1
        assert any((x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held, len(w), sum(c[y] > 0 for y in w), n) and abs(x.base_score - base) < 1e-6 and x.score < 0 for x in got[a])


def brute_scores(train, texts, depth=5):
    """log10 probabilities by the definition of context-tree weighting, one decision at a time."""
    seen = [collections.defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    below = [collections.defaultdict(set) for _ in range(depth + 1)]

    def decisions(text):
        x = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(x)):
            for j in range(8):
                yield x[i - depth : i], 1 << j | x[i] >> (8 - j), x[i] >> (7 - j) & 1

    for t in train:
        for context, node, bit in decisions(t):
            for d in range(depth + 1):
                seen[d][context[depth - d :], node][bit] += 1
                if d:
                    below[d - 1][context[depth - d + 1 :], node].add(context[depth - d :])
    own = lambda d, c, node: (lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi))(*seen[d][c, node])

    @functools.cache
    def children(d, c, node):
        return sum(weighted(d + 1, x, node) for x in below[d][c, node])

    @functools.cache
    def weighted(d, c, node):
        return own(d, c, node) if d == depth else math.log(0.5) + np.logaddexp(own(d, c, node), children(d, c, node))

    @functools.cache
    def one(context, node):
        p = None
        for d in range(depth, -1, -1):
            c = context[depth - d :]
            if (c, node) not in seen[d]:
                continue
            a, b = seen[d][c, node]
            kt = (b + 0.5) / (a + b + 1)
            if p is None:
                p = kt
            else:
                share = 1 / (1 + math.exp(min(700, children(d, c, node) - own(d, c, node))))
                p = share * kt + (1 - share) * p
        return 0.5 if p is None else p

    return [sum(math.log10(q if bit else 1 - q) for c, node, bit in decisions(t) for q in [one(c, node)]) for t in texts]


def test_lm_scores_by_their_definition(spark, monkeypatch):
    """Depth 5, with more contexts than are looked up at once and than a block holds."""
    monkeypatch.setattr(lm_score, "GRAMS", 20)
    monkeypatch.setattr(lm_score, "WORDS", 3)
    monkeypatch.setattr(lm_score, "BLOCK", 25)
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["the", "Then", "näh", "anna", f"w{r.randrange(40)}"]) for _ in range(r.randrange(9)))) for i in range(60)] + [(1000, None), (1001, "zq unseen"), (None, "null id")]
    low = [(i, (t or "").translate(LOWER).encode()) for i, t in rows]
    train = [t for i, t in low if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    assert len({x[k : k + 6] for t in train for x in [b"\xff" * 5 + t + b"\xff"] for k in range(len(x) - 5)}) > 200
    want = dict(zip([i for i, _ in low], brute_scores(train, [t for _, t in low]), strict=True))
    got = {x.doc_id: x.score for x in lm_score.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == pytest.approx(want, rel=1e-7)


def test_lm_without_texts(spark):
    assert lm_score.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# classifiers


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (None, "x y")], "doc_id long, text string")
    got = quality.quality_scores(docs.select("doc_id", "text").union(extra), labels)
    assert got.count() == docs.count() + 3 and got.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0
    held = got.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    assert rows_of(got.where("held_out"), "doc_id") == sorted(((i,) for (i,) in rows_of(got, "doc_id") if i is None or zlib.crc32(str(i).encode()) % 5 == 0), key=repr)


def test_random_indexing_against_dense_sums(spark):
    r = random.Random(7)
    texts = [" ".join(r.choice(["The", "cat", "SAT", "on", "12", "x-y", "é"]) for _ in range(r.randrange(12))) for _ in range(40)] + [None, ""]
    want = np.zeros((quality.ROWS, quality.DIMS))
    for t in texts:
        b = (t or "").encode()
        h, w = quality.tokens(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert len(h) == 2 * len(SPACED.findall(t or ""))
        index = np.zeros((len(h), quality.DIMS))
        for place, sign in quality.index_vectors(h):
            np.add.at(index, (np.arange(len(h)), place.astype(int)), sign)
        for i in range(len(h)):
            for j in range(len(h)):
                if 0 < abs(i - j) <= 2:
                    want[int(h[i]) % quality.ROWS] += index[j]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    table = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    assert np.allclose(table, want, atol=1e-6)
    b, offs = np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8), np.cumsum([0, *(len((t or "").encode()) for t in texts)])
    x = quality.features(b, offs, table)
    for k, t in enumerate(texts):
        h, _ = quality.tokens(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))
        n, d = len(h) // 2, quality.DIMS
        assert x[k, -1] == pytest.approx(math.log1p(n) / 5)
        for part in (0, 1):
            v = table[(h[part::2] % np.uint64(quality.ROWS)).astype(int)]
            assert np.allclose(x[k, 2 * part * d : (2 * part + 1) * d], v.mean(0) if n else 0, atol=1e-5)
            assert np.allclose(x[k, (2 * part + 1) * d : (2 * part + 2) * d], v.std(0) if n else 0, atol=1e-3)


def test_gradients_by_differences():
    r = np.random.default_rng(5)
    z, y = r.normal(size=(20, 6)), (r.random(20) < 0.4).astype(float)
    p = [r.normal(size=(6, 4)), r.normal(size=4), r.normal(size=4), np.float64(0.3)]

    def loss():
        logit = np.tanh(z @ p[0] + p[1]) @ p[2] + p[3]
        return np.logaddexp(0, -np.where(y > 0.5, 1, -1) * logit).mean() + 5e-5 * ((p[0] ** 2).sum() + (p[2] ** 2).sum())

    for q, g in enumerate(quality.gradients(p, z, y)):
        flat = np.atleast_1d(p[q]).astype(float)
        for at in list(np.ndindex(flat.shape))[:10]:
            both = []
            for e in (1e-6, -1e-6):
                moved = flat.copy()
                moved[at] += e
                kept, p[q] = p[q], moved if np.ndim(p[q]) else moved[0]
                both.append(loss())
                p[q] = kept
            assert np.atleast_1d(g)[at] == pytest.approx((both[0] - both[1]) / 2e-6, rel=1e-4, abs=1e-7)


def test_network_learns_and_is_calibrated():
    r = np.random.default_rng(9)
    x = r.normal(size=(6000, 5))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] * x[:, 1] + x[:, 2])))
    y = (r.random(6000) < p).astype(float)
    score = quality.Network(x[:5000], y[:5000]).score(x[5000:])
    assert np.abs(score - p[5000:]).mean() < 0.08
    for low in (0.0, 0.25, 0.5, 0.75):
        k = (score >= low) & (score < low + 0.25)
        assert abs(y[5000:][k].mean() - score[k].mean()) < 0.1


def test_quality_of_odd_rows(spark):
    """Repeated ids and rows, labels that clash or are null, a very long text, clashing names."""
    long = "good words " * 200_000
    rows = [(i, "good words here" if i % 2 else "bad! words, 123 here", i) for i in range(40)] + [(1, "another text of id 1", 0), (1, "another text of id 1", 0), (50, long, 1), (51, None, 1), (None, "x", 1)]
    docs = spark.createDataFrame([(a, b, float(c), "clash", 0) for a, b, c in rows], "doc_id long, text string, score double, i string, predicted int")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(1, 0, "x"), (3, None, "x"), (4, 7, "x"), (None, 1, "x"), (50, 1, None)], "doc_id long, quality int, text string")
    got = quality.quality_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 45
    scores = {(r.doc_id, r.score) for r in got.collect()}
    assert len({s for i, s in scores if i == 1}) == 2 and all(0 <= s <= 1 for _, s in scores)


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), none).count() == 0


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(10**9, None, "en"), (10**9 + 1, "12 !?", "en"), (10**9 + 2, "", None), (10**9 + 3, "日本", None)], "doc_id long, text string, lang string")
    got = language.language_id(docs.union(extra))
    pred = {r.doc_id: r for r in got.collect()}
    assert [pred[10**9 + k].lang_pred for k in range(3)] == ["und"] * 3 and pred[10**9 + 3].lang_pred in ("en", "fr", "de", "es")
    held = [(pred[r.doc_id].lang_pred, r.lang) for r in docs.collect() if pred[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97 and all(0 <= r.score <= 1 for r in pred.values())


def test_language_many(spark):
    r = random.Random(1)
    names = [f"l{k:02}" for k in range(40)]
    rows = [(i, " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz"[k % 20 : k % 20 + 6]) + str(k)[-1] * 0 for _ in range(5)) + "xyzuvwqj"[k // 5] for _ in range(60)), names[k]) for i in range(800) for k in [i % 40]]
    got = language.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    truth = {i: n for i, _, n in rows}
    held = [(x.lang_pred, truth[x.doc_id]) for x in got.collect() if x.held_out]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_language_of_more_than_256_labels(spark):
    r = random.Random(2)
    words = [["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(5)] for _ in range(290)]
    rows = [(k * 10 + i, " ".join(r.choices(words[k], k=20)), f"l{k:03}") for k in range(290) for i in range(4 if k < 256 else 3)]
    truth = {i: x for i, _, x in rows}
    got = language.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert np.mean([x.lang_pred == truth[x.doc_id] for x in got if truth[x.doc_id] >= "l256"]) > 0.9


def test_filter_holds_the_exact_sets(spark):
    r = random.Random(11)
    words = {k: ["".join(r.choice("abcdefghijklmnopqrst"[i : i + 12]) for _ in range(r.randrange(3, 9))) for _ in range(60)] for i, k in enumerate(["aa", "bb", "cc"])}
    common_ = ["shared", "words"]
    rows = [(i, " ".join(r.choices([*words[k], *common_], k=30)).title(), k) for i in range(90) for k in ["aa", "bb", "cc"]] + [(0, "twice the same text", "aa")] * 5 + [(1, None, "aa"), (2, "no language", None)]
    f = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang")
    counts = {k: collections.Counter() for k in words}
    for t, k in {(t, k) for _, t, k in rows if t and k}:
        x = f" {re.sub('[^a-z]+', ' ', t.lower())} "
        counts[k].update(x[i : i + 4] for i in range(len(x) - 3))
    share = {k: {g: n / c.total() for g, n in c.items()} for k, c in counts.items()}
    every = {g for c in counts.values() for g in c}
    want = {g: {k for k in words if share[k].get(g, 0) >= language.LEAST and share[k].get(g, 0) >= language.SHARE * max(s.get(g, 0) for s in share.values())} for g in every}
    s = language.slots_of(np.array([int.from_bytes(g.encode(), "big") for g in sorted(every)], np.uint64))
    mask = f.table[0][s[0]] & f.table[0][s[1]] & f.table[0][s[2]]
    got = {g: {f.langs[b] for b in range(3) if m >> b & 1} for g, m in zip(sorted(every), mask.tolist(), strict=True)}
    assert all(got[g] >= want[g] for g in every) and sum(got[g] != want[g] for g in every) <= 1 and len(every) > 500
    assert f.usual == "aa"


def test_language_of_odd_rows(spark):
    """Repeated rows, clashing names, a very long text; a language of one text that is repeated very often is learned."""
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in range(300)] + [(1000 + i, f"der hund und die katze nummer {i} im garten", "de") for i in range(20)] + [(5, "the cat sat on the mat and the dog", "en"), (2000, "der hund " * 100_000, None), (None, "die katze", None)]
    df = spark.createDataFrame([(a, b, c, 0.5, "x", "y") for a, b, c in rows], "doc_id long, text string, lang string, score double, lang_pred string, x string")
    got = {r.doc_id: r.lang_pred for r in language.language_id(df).collect()}
    assert (got[0], got[1003], got[2000], got[None]) == ("en", "de", "de", "de")
    model = language.learn(df, "text", "lang")
    out = language.identify(df, model, ["doc_id", "score", "lang_pred", "x"], keep_text=True)
    assert out.columns == ["doc_id", "x", "lang_pred", "score", "text"] and out.count() == len(rows)


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert rows_of(language.language_id(df), "lang_pred", "score") == [("und", 0.0)]
    assert language.language_id(df.limit(0)).count() == 0


def test_bloom_false_positives_are_corrected():
    table = np.zeros((1, language.SLOTS), dtype=np.uint32)
    r = np.random.default_rng(1)
    table[0][r.random(language.SLOTS) < 0.5] |= 2
    f = language.Filter(["a", "b"], table, "a")
    g = r.integers(0, 1 << 32, 4000, dtype=np.uint64)
    for s in language.slots_of(g[:1000]):
        table[0][s] |= 1
    best, score = f.predict(g[:1000], np.array([0, 1000]))
    assert best[0] == 0 and score[0] == pytest.approx(1, abs=0.01) and f.fp[1] == pytest.approx(0.125, abs=0.01)


# token counts


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_token_counts(spark, block):
    rows = [(i, t) for i, t in enumerate(["", "one two", "Ünï çödé " * 40, "\x00\x00\x00", " " * 3000, "x" * 5000])] + [(None, "null"), (-5, None), (-(1 << 63), "low"), ((1 << 63) - 1, "high"), (1, "one two"), (1, "one two")]
    t = token_counts.Tokenizer(token_counts.ranks_of(token_counts.VOCABULARY))
    got = token_counts.token_counts(spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, n_tokens int"), block=block)
    assert rows_of(got) == sorted(((i, len(t.encode(x or ""))) for i, x in rows), key=repr)


def test_token_files_hold_few_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 400)
    monkeypatch.setattr(token_counts, "FILE_RUNS", 2)
    rows = [(i, "some words " * (i % 9) + "x" * (2000 if i == 50 else 1)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    token_counts.write_tokens(df, str(tmp_path / "t"))
    sizes = [p.stat().st_size for p in (tmp_path / "t").glob("part-*")]
    assert len(sizes) > 3 and sorted(sizes)[-2] <= 2 * 402
    t = token_counts.Tokenizer(token_counts.ranks_of(token_counts.VOCABULARY))
    assert rows_of(token_counts.scan_tokens(spark, str(tmp_path / "t"))) == sorted(((i, len(t.encode(x))) for i, x in rows), key=repr)


def test_torn_token_file_is_told(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([5, 6, 0, *token_counts.header(8), 9, 0], dtype="<u2").tobytes())
    assert rows_of(token_counts.scan_tokens(spark, str(tmp_path))) == sorted([(None, None), (8, 1)], key=repr)


def test_token_file_without_its_last_end(spark, tmp_path):
    one = np.array([*token_counts.header(7), 5, 6, 0, *token_counts.header(8), 9], dtype="<u2")
    (tmp_path / "a.bin").write_bytes(one.tobytes())
    for block in (3, 1000):
        assert rows_of(token_counts.scan_tokens(spark, str(tmp_path), block)) == [(7, 2), (8, 1)]
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tokeniser_on_a_megabyte_of_white_space():
    t = token_counts.Tokenizer(token_counts.ranks_of(token_counts.VOCABULARY))
    text = "\n" * 1_000_000 + "x"
    assert t.encoding.decode(t.encode(text).tolist()) == text


# pipeline


def test_pipeline_against_brute_force(spark):
    from test_near_dedup import brute
    from test_suffix_dedup import left_text

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rows = {r.doc_id: r.text for r in docs if any(c.isalpha() for c in r.text or "")}
    keep = {i for i, _, _, kept in brute(list(rows.items()), 5) if kept}
    rows = [(i, t) for i, t in rows.items() if i in keep]
    left = {i: x for (i, t), x in zip(rows, left_text(rows, 200), strict=True) if x == t or SPACED.search(x)}
    clean = {i for i, *_, bad in brute_hits(list(left.items()), [(b.item_id, b.text) for b in bench]) if not bad}
    with scratch(spark):
        out = corpus_pipeline.run(spark, SF)
        got = {r.doc_id: r for r in out.collect()}
    assert set(got) == clean and 0 < len(clean) < len(rows)
    assert all(got[i]["size"] == len(SPACED.findall(left[i])) and got[i].n_chars == len(left[i]) and got[i].taken <= 2 * got[i]["size"] for i in clean)
    total = sum(r["size"] for r in got.values())
    assert sum(r.taken for r in got.values()) == pytest.approx(1.5 * total, abs=len({r.source for r in docs}))
    with pytest.raises(Exception, match="(?i)exist"):  # the block's end deletes all that was written in it
        out.collect()


CLASH = "lang_pred string, score double, id long, key long, component_id long, kept string, spans string, n_bytes int, items string, n_hit int, size long, target double, position long, p string"


def _odd(spark, rows):
    """documents with columns that are named like those that stages make."""
    df = spark.createDataFrame([(*r, *([None] * 14)) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")
    return df.withColumns({"id": F.lit(9).cast("long"), "key": F.lit(9).cast("long"), "spans": F.lit("x"), "size": F.lit(7).cast("long")})


def test_pipeline_stages_on_odd_rows(spark):
    r = random.Random(12)
    words = [f"{a}{b}{c}" for a in ("bo", "ka", "ri") for b in ("ta", "lo", "ne") for c in ("s", "m", "", "x")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    one, item = text(60), spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    near, long = one + " tail", text(60_000)
    rows = [(1, one, "en", "a", 5), (1, one, "en", "a", 5), (2, near, None, "a", 5), (2, near, None, None, None), (None, text(50), None, None, None), (None, text(50), None, None, None), (3, None, "en", "a", None), (4, "", "en", None, 0), (5, "12 -- 34", "en", "b", 2), (6, long, "en", "b", 7), (7, text(30) + " " + item + " " + text(30), "en", None, 1), (8, text(40), None, "c", 1)]
    rows += [(100 + i, text(40), "en", "a", 1) for i in range(20)]
    stages = dict(corpus_pipeline.STAGES)
    docs, columns = _odd(spark, rows), ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)
    more = list(range(100, 120))
    with scratch(spark):
        kept = stash(stages["language"](spark, docs, SF), "kept")
        assert kept.columns == columns and ids(kept) == sorted([1, 1, 2, 2, None, None, 6, 7, 8, *more], key=repr)
        kept = stash(stages["near_duplicates"](spark, _odd(spark, kept.collect()), SF), "kept")
        assert kept.columns == columns and ids(kept) == sorted([1, None, None, 6, 7, 8, *more], key=repr)
        kept = stash(stages["suffix_repeats"](spark, _odd(spark, kept.collect()), SF), "kept")
        assert kept.columns == columns and ids(kept) == sorted([1, None, None, 6, 7, 8, *more], key=repr)
        assert {r.doc_id: r.text for r in kept.collect()}[6] == long
        kept = stash(stages["decontamination"](spark, _odd(spark, kept.collect()), SF), "kept")
        assert kept.columns == columns and ids(kept) == sorted([1, None, None, 6, 8, *more], key=repr)
        out = stages["mixing"](spark, _odd(spark, kept.collect()), SF)
        assert {"doc_id", "taken", "position", "again"} <= set(out.columns) and len(set(out.columns)) == len(out.columns) and ids(out) == ids(kept)
    # later stages called with what the first ones would have taken away
    with scratch(spark):
        assert ids(stages["near_duplicates"](spark, docs, SF)) == sorted([1, None, None, 3, 4, 5, 6, 7, 8, *more], key=repr)
        cut = {}
        for x in stages["suffix_repeats"](spark, docs, SF).collect():
            cut.setdefault(x.doc_id, []).append(x.text)
        assert 1 not in cut and 2 not in cut and cut[3] == [""] and cut[6] == [long]  # equal rows repeat each other
        assert ids(stages["decontamination"](spark, docs, SF)) == sorted((i for i, *_ in rows if i != 7), key=repr)
        assert ids(stages["mixing"](spark, docs, SF)) == sorted((i for i, *_ in rows), key=repr)


def test_pipeline_stages_on_nothing(spark):
    empty = _odd(spark, [])
    with scratch(spark):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, empty, SF).count() == 0


def test_language_stage_keeps_documents_if_nothing_can_be_learned(spark):
    docs = _odd(spark, [(1, "some words", None, "a", 1), (2, "12", None, "a", 1), (3, None, None, "a", 1), (4, "日本", None, None, None)])
    assert rows_of(corpus_pipeline.language(spark, docs, SF), "doc_id") == [(1,), (4,)]
