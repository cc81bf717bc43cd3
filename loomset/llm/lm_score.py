"""Scoring texts by context-tree weighting over bytes, next to a unigram baseline over words.

Context-tree weighting. A text is its bytes (A-Z lower-cased) and an end symbol, FF, which UTF-8 never uses. Each byte is eight
binary decisions; each decision has, for the empty context and for those of the 1 to DEPTH bytes before it, a
Krichevsky-Trofimov estimate from the training counts. With weights 1/2 at each node, the probability of the training
decisions at a node is the mean of its own estimate's and of the product of its children's; so each node's own estimate has a
posterior weight against the deeper ones (_Tree). A decision's probability is the mix over all depths of its context;
contexts that were never seen end the path. It is a proper distribution over texts. score: log10 probability.

Baseline. Tokens are words and one end for each text; log10((c + 0.5) / (N + 0.5 (V + 1))), summed.

Scale: all training texts are counted, in sums before the shuffle: n-grams of DEPTH + 1 bytes, and words; no context is left
out. The n-grams are dealt out by the last SPLIT bytes of their contexts, so that each block has whole subtrees, weighs them
bottom up and sends the sums of their roots to the driver, which holds the depths under SPLIT (at most all n-grams of SPLIT
bytes) and broadcasts them; then each block gives its n-grams, those of held-out texts too, their probabilities. Looked up at
once are the GRAMS most frequent n-grams and the WORDS most frequent words; all others of a text by shuffle joins with all
n-grams and the whole vocabulary, with the same result. Texts are scored whole, in runs of documents.

Nulls and edge cases: null text is empty: one token, the end. A null id is held out. Repeated rows are texts of their
own. Without training texts N, V and all c are 0, the baseline of a token is 0, and each decision has probability 1/2.
Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import _LOWER, chunks, mix, plain, trimmed, utf8, whole, Words
from loomset.llm.language import held_out
from loomset.scratch import stash

DEPTH, GRAMS, WORDS, RUN = 5, 3 << 17, 1 << 16, 2 << 20
SPLIT, BLOCK = 3, 1 << 17
END = 0xFF


def grams(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and end of a run of texts, the DEPTH bytes before it and itself as an integer; and where each text begins."""
    n = len(offs) - 1
    x = np.full(len(b) + DEPTH * (n + 1), END, dtype=np.uint8)
    x[np.arange(len(b)) + np.repeat(np.arange(1, n + 1) * DEPTH, np.diff(offs))] = _LOWER[b]
    g = np.zeros(len(x) - DEPTH, dtype=np.uint64)
    for k in range(DEPTH + 1):
        g = g << np.uint64(8) | x[k : k + len(g)]
    size = np.diff(offs) + 1
    starts = np.concatenate([[0], np.cumsum(size)])
    keep = np.arange(starts[-1]) + np.repeat(np.arange(n) * (DEPTH - 1), size)
    return g[keep], starts


@trimmed
def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, offs = utf8(batch.column(0))
        train = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
        for i, j in chunks(offs, RUN):
            g, starts = grams(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            g = np.sort(g << np.uint64(1) | np.repeat(train[i:j], np.diff(starts)))
            first = np.flatnonzero(np.concatenate([[True], g[1:] >> np.uint64(1) != g[:-1] >> np.uint64(1)]))
            n = np.add.reduceat((g & np.uint64(1)).astype(np.int64), first)
            yield pa.record_batch([pa.array((g[first] >> np.uint64(1)).view(np.int64)), pa.array(n), pa.array(np.diff(np.concatenate([first, [len(g)]])))], ["g", "n", "m"])


@trimmed
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, offs = utf8(batch.column(0))
        for i, j in chunks(offs, RUN):
            h, n = np.unique(Words(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i]).hash, return_counts=True)
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])


def _lgamma(x: np.ndarray) -> np.ndarray:
    y, low = x + 8, np.ones_like(x)
    for k in range(8):
        low *= x + k
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - np.log(low)


def _in_parts(f, *x: np.ndarray, size: int = 1 << 17) -> np.ndarray:
    """f over parts of arrays, to bound what it holds meanwhile."""
    return np.concatenate([f(*(v[i : i + size] for v in x)) for i in range(0, len(x[0]), size)] or [np.zeros(0)])


def _own(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    a, b = zero.astype(np.float64), one.astype(np.float64)
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - np.log(np.pi)


class _Tree:
    """The nodes of depths first and deeper: key (context << 8 | decision) and the probability of a 1 for a path that ends there."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], first: int = 0, deep: tuple[np.ndarray, np.ndarray] | None = None, above: _Tree | None = None):
        """counts: for each depth, sorted integers of context and byte, and how often they occur. The list is emptied.

        deep: nodes of the last depth, and the sums of the logarithms of what is below them; None if nothing is. above: the tree
        of the depths before first; without it only `weighted` is made, the logarithms of the first depth's nodes.
        """
        self.keys: list[np.ndarray] = []
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        while counts:
            g, n = counts.pop(0)
            key, zero, one = [], [], []
            for j in range(8):  # g is sorted, so the n-grams below a node are a run
                prefix = g >> np.uint64(8 - j)
                start = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(g) else np.zeros(0, np.int64)
                ones = n * (g >> np.uint64(7 - j) & np.uint64(1)).astype(np.int64)
                both, ones = (np.add.reduceat(v, start) if len(start) else np.zeros(0, np.int64) for v in (n, ones))
                prefix = prefix[start]
                key.append(prefix >> np.uint64(j) << np.uint64(8) | np.uint64(1 << j) | prefix & np.uint64((1 << j) - 1))
                zero.append((both - ones).astype(np.float64))
                one.append(ones.astype(np.float64))
            k = np.concatenate(key)
            order = np.argsort(k)
            self.keys.append(k[order])
            seen.append((np.concatenate(zero)[order], np.concatenate(one)[order]))
        # bottom up: log odds of each node's own estimate against its children's
        odds: list[np.ndarray] = [np.zeros(0)] * len(seen)
        below = None
        if deep is not None:
            below = np.zeros(len(self.keys[-1]))
            below[np.searchsorted(self.keys[-1], deep[0])] = deep[1]
        for d in range(len(seen) - 1, -1, -1):
            own = _in_parts(_own, *seen[d])
            if below is None:
                odds[d], self.weighted = np.full(len(own), np.inf), own
            else:
                odds[d], self.weighted = own - below, np.logaddexp(own, below) - np.log(2)
            if d:
                up = np.searchsorted(self.keys[d - 1], self._parent(self.keys[d], first + d - 1))
                below = np.bincount(up, self.weighted, minlength=len(self.keys[d - 1]))
        if first and above is None:
            return
        # top down: the mix along the path to each node; passed: what it is so far below the last depth, and the share left
        self.p: list[np.ndarray] = []
        parents, self.passed = (above.keys[-1], above.passed) if above else (None, None)
        for d, k in enumerate(self.keys):
            zero, one = seen[d]
            seen[d] = ()
            kt = (one + 0.5) / (zero + one + 1)
            if parents is None:
                head, rest = np.zeros(len(k)), np.ones(len(k))
            else:
                up = np.searchsorted(parents, self._parent(k, first + d - 1))
                head, rest = (v[up] for v in self.passed)
            share = 1 / (1 + np.exp(-np.clip(odds[d], -700, 700)))
            self.p.append(head + rest * kt)
            parents, self.passed = k, [head + rest * share * kt, rest * (1 - share)]

    @staticmethod
    def _parent(key: np.ndarray, depth: int) -> np.ndarray:
        return (key >> np.uint64(8) & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8) | key & np.uint64(255)

    def log10(self, g: np.ndarray, above: _Tree | None = None) -> np.ndarray:
        """log10 probability of each n-gram's last byte after the others; above: the tree of the depths before."""
        keys, ps = ([*above.keys, *self.keys], [*above.p, *self.p]) if above else (self.keys, self.p)
        out = np.zeros(len(g))
        byte, context = g & np.uint64(255), g >> np.uint64(8)
        for j in range(8):
            node = np.uint64(1 << j) | byte >> np.uint64(8 - j)
            one = (byte >> np.uint64(7 - j) & np.uint64(1)).astype(bool)
            p, open_ = np.full(len(g), 0.5), np.ones(len(g), dtype=bool)
            for depth in range(len(keys) - 1, -1, -1):
                k = keys[depth]
                left = np.flatnonzero(open_)
                if not len(left) or not len(k):
                    continue
                key = (context[left] & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8) | node[left]
                at = np.minimum(np.searchsorted(k, key), len(k) - 1)
                ok = k[at] == key
                p[left[ok]], open_[left[ok]] = ps[depth][at[ok]], False
            out += np.log10(np.where(one, p, 1 - p))
        return out


class Table:
    """Values of 64-bit keys by open addressing, looked up in arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(2 * len(keys)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.full = np.zeros(1 << bits, dtype=bool)
        self.keys, self.values = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits, dtype=values.dtype)
        self.probes, rest = 0, np.arange(len(keys))
        while len(rest):
            slot = self._slot(keys[rest], self.probes)
            free = np.flatnonzero(~self.full[slot])
            taken = free[np.unique(slot[free], return_index=True)[1]]
            self.full[slot[taken]] = True
            self.keys[slot[taken]], self.values[slot[taken]] = keys[rest[taken]], values[rest[taken]]
            rest = np.delete(rest, taken)
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((mix(keys) + np.uint64(probe)) & self.mask).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys are there."""
        slot = self._slot(keys, 0)
        ok = self.full[slot] & (self.keys[slot] == keys)
        out = np.where(ok, self.values[slot], 0).astype(np.float64)
        rest = np.flatnonzero(~ok & self.full[slot])
        for probe in range(1, self.probes):
            if not len(rest):
                break
            slot = self._slot(keys[rest], probe)
            hit = self.full[slot] & (self.keys[slot] == keys[rest])
            out[rest[hit]], ok[rest[hit]] = self.values[slot[hit]], True
            rest = rest[~hit & self.full[slot]]
        return out, ok


class Model:
    """The whole tree in one place, for small corpora: gives what `lm_scores` gives."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        self.tree = _Tree(counts)

    def score(self, b: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 probability of each text of a run."""
        g, starts = grams(b, offs)
        kinds, at = np.unique(g, return_inverse=True)
        return np.add.reduceat(self.tree.log10(kinds)[at], starts[:-1]) if len(starts) > 1 else np.zeros(0)


def _summed(g: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct last `size` bytes of n-grams, and their counts."""
    low, at = np.unique(g & np.uint64((1 << 8 * size) - 1), return_inverse=True)
    return low, np.bincount(at, n, minlength=len(low)).astype(np.int64)


def _levels(g: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of depths SPLIT to DEPTH, from those n-grams that training texts have."""
    seen = n > 0
    return [_summed(g[seen], n[seen], depth + 1) for depth in range(SPLIT, DEPTH + 1)]


def _list(*parts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts)))


def _blocks(size: int):
    """Rows of whole subtrees with about `size` n-grams: the n-grams, and the sums that their roots add to the depth above."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in batch.columns[:3]] for batch in batches]
        if not parts:
            return
        g, n, m = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        c = g >> 8 & (1 << 8 * SPLIT) - 1
        order = np.argsort(c)
        g, n, m, c = g[order], n[order], m[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        i = 0
        while i < len(g):
            to = np.searchsorted(first, i + size)
            j = int(first[to]) if to < len(first) else len(g)
            x = g[i:j].view(np.uint64)
            tree = _Tree(_levels(x, n[i:j]), SPLIT)
            key, at = np.unique(tree._parent(tree.keys[0], SPLIT - 1), return_inverse=True)
            low, k = _summed(x[n[i:j] > 0], n[i:j][n[i:j] > 0], SPLIT)
            yield pa.record_batch([_list(g[i:j]), _list(n[i:j]), _list(m[i:j]), _list(key.view(np.int64)), _list(np.bincount(at, tree.weighted, minlength=len(key)).astype(np.float64)), _list(low.view(np.int64)), _list(k)], ["g", "n", "m", "key", "deep", "low", "k"])
            i = j

    return run


def _values(shared):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = whole(shared.value, _Tree)
        for batch in batches:
            for r in range(batch.num_rows):
                g, n, m = (batch.column(k)[r].values.to_numpy() for k in range(3))
                x = g.view(np.uint64)
                tree = _Tree(_levels(x, n), SPLIT, above=top)
                yield pa.record_batch([pa.array(g), pa.array(m), pa.array(_in_parts(lambda y, t=tree: t.log10(y, top), x))], ["g", "m", "v"])

    return run


def _frequent(values: DataFrame) -> DataFrame:
    """The most frequent n-grams, at most GRAMS, by steps of 1/64 of a doubling: no sort, and only counts of steps are gathered."""
    step = F.floor(F.log2("m") * 64)
    total, least = 0, None
    for row in sorted(values.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row[1]
        if total > GRAMS:
            break
        least = row[0]
    return values.where(step >= F.lit(least))


def _pairs(rows: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums by key over lists of keys and values, sorted by key."""
    p = rows.select(F.explode(F.arrays_zip(key, value)).alias("x")).groupBy(f"x.{key}").agg(F.sum(f"x.{value}").alias("s")).toPandas()
    k = p[key].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(k)
    return k[order], p["s"].to_numpy()[order]


def learn(texts: DataFrame) -> DataFrame:
    """texts: text, and train: whether it is learned from. For each n-gram of all texts g, how often it is there (m), and its log10 probability v."""
    counts = texts.mapInArrow(_count_grams, "g long, n long, m long").groupBy("g").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    dealt = counts.withColumn("c", F.expr(f"shiftright(g, 8) & {(1 << 8 * SPLIT) - 1}L")).repartition("c")
    blocks = stash(dealt.mapInArrow(_blocks(BLOCK), "g array<long>, n array<long>, m array<long>, key array<long>, deep array<double>, low array<long>, k array<long>"), "grams")
    low, n = _pairs(blocks, "low", "k")
    key, deep = _pairs(blocks, "key", "deep")
    n = n.astype(np.int64)
    top = _Tree([_summed(low, n, depth + 1) for depth in range(SPLIT)], deep=(key, deep.astype(np.float64)))
    shared = texts.sparkSession.sparkContext.broadcast(plain(top))
    return stash(blocks.select("g", "n", "m").mapInArrow(_values(shared), "g long, m long, v double"), "gram-values")


def _score(grams_often, words, train_docs: int):
    """Sums over what is looked up at once, and the rest of each text; without grams_often, of the baseline only."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = grams_often and whole(grams_often.value, Table), whole(words.value, Table)
        for batch in batches:
            b, offs = utf8(batch.column(1))
            for i, j in chunks(offs, RUN):
                part, o = b[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                score, far = np.zeros(j - i), pa.nulls(j - i, pa.list_(pa.int64()))
                if common:
                    g, starts = grams(part, o)
                    v, ok = common.get(g)
                    score = np.add.reduceat(v, starts[:-1])
                    far = _list(*np.split(g[~ok].view(np.int64), np.cumsum(np.add.reduceat(~ok, starts[:-1], dtype=np.int64))[:-1]))
                w = Words(part, o)
                c, ok = often.get(w.hash)
                log = np.where(ok, np.log10(c + 0.5), 0.0)
                base = np.bincount(w.doc, log, minlength=j - i) + np.log10(train_docs + 0.5)
                known = np.bincount(w.doc[ok], minlength=j - i) + (train_docs > 0)
                rest, size = w.hash[~ok], np.bincount(w.doc[~ok], minlength=j - i)
                rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(rest.view(np.int64)))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(w.count + 1), pa.array(known.astype(np.int64)), pa.array(base), rare, far, pa.array(score)], ["id", "n_tokens", "known", "base", "rare", "far", "score"])

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: bool = True) -> DataFrame:
    """One row per document: id, held_out (crc32 of the id mod 5 = 1: not learned from), n_tokens, n_known, train_tokens, base_score,
    score. Without tree: the baseline alone, and no score."""
    context = docs.sparkSession.sparkContext
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    train = docs.where(~held_out(F.col(id_col), 1)).select(text.alias("text"))
    values = common = None
    if tree:
        values = learn(docs.select(text.alias("text"), (~held_out(F.col(id_col), 1)).alias("train")))
        top = _frequent(values).select("g", "v").toPandas()
        common = context.broadcast(plain(Table(top["g"].to_numpy(np.int64).view(np.uint64), top["v"].to_numpy(np.float64))))
    vocabulary = stash(train.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    ends = train.count()
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = n + ends, v + (ends > 0)
    top = vocabulary.orderBy(F.col("n").desc(), "h").limit(WORDS).toPandas()
    often = context.broadcast(plain(Table(top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.float64))))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(_score(common, often, ends), f"id {kind}, n_tokens long, known long, base double, rare array<long>, far array<long>, score double")
    rows = stash(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode("rare").alias("h")).groupBy("row", "h").agg(F.count("*").alias("k"))
    rare = rare.join(vocabulary, "h", "left").groupBy("row").agg(F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("n").isNotNull(), F.col("k"))).alias("also"), F.lit(0.0).alias("deep"))
    more = rare
    if tree:
        far = rows.select("row", F.explode("far").alias("g")).join(values.select("g", "v"), "g").groupBy("row").agg(F.lit(0.0).alias("more"), F.lit(0).cast("long").alias("also"), F.sum("v").alias("deep"))
        more = rare.union(far).groupBy("row").agg(*(F.sum(x).alias(x) for x in ("more", "also", "deep")))
    zero = F.lit(0)
    out = rows.drop("rare", "far").join(more, "row", "left")
    per_token = float(np.log10(n + 0.5 * (v + 1)))
    return out.select(
        F.col("id").alias(id_col), held_out(F.col("id"), 1).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("also", zero)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), *[(F.col("score") + F.coalesce("deep", F.lit(0.0))).alias("score")] * tree,
    )


#: Of the baseline; base_score to three digits, as sums of logarithms depend on their order.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 5 = 1 AS held_out FROM documents),
t AS (SELECT doc_id, held_out, unnest(list_append(w, chr(10))) AS t FROM d),
c AS (SELECT t, count(*) AS c FROM t WHERE NOT held_out GROUP BY t),
n AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM c)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens,
    round(sum(log10((coalesce(c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1)))), 3) AS base_score
FROM t LEFT JOIN c USING (t), n GROUP BY doc_id
"""
