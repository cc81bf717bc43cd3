"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network in numpy.

Each word gives two tokens: its shape (case, digits, punctuation, length, and whether it repeats one of the two words
before it) and its lower-cased form. Every token has a fixed sparse index vector (SIGNS entries of +1 or -1 among DIMS, by
its hash). The vector of a token is the sum of the index vectors of its neighbours up to two tokens away, over all
documents, scaled to unit length; tokens are kept in a table of ROWS rows by hash, so the table's size is fixed. A document
is the mean and the standard deviation of its words' and shapes' vectors, and the logarithm of its word count.

The network (one hidden layer of HIDDEN tanh units) is trained by Adam on at most SAMPLE labelled documents (the documented
bound, one text for each id). A tenth of these is left out to stop early, and another tenth to fit one temperature, by which
logits are divided before the logistic function.

Scale: token vectors are counted over all documents in one pass, each task adding into its own table; the tables are added
in the cluster. What is broadcast is the table of ROWS x DIMS floats and the network, of fixed size. Scoring is one pass
without a shuffle.

Nulls and edge cases: null, empty and wordless texts are a document of zero vectors and get its score. Labels that are null or
neither 0 nor 1 are not learned from; of several labels of an id the mean counts, and of several texts the smallest is learned
from, while all are scored. Without labels, or with one class only, every score is the share of label 1 (0.5 if there is none).
A null id is held out. Very long texts are read whole. An empty table gives an empty result. Only id, text and the label are
read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import chunks, groups, mix, trimmed, utf8, Words
from loomset.llm.language import held_out

ROWS, DIMS, SIGNS, HIDDEN, SAMPLE = 1 << 14, 32, 2, 32, 20_000
FEATURES = 4 * DIMS + 1


def tokens(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, Words]:
    """Hashes of shape and word of each word, in turn."""
    w = Words(b, offs)
    size = w.end - w.start

    def count(flags: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return run[w.end] - run[w.start]

    upper, lower = count((b >= 65) & (b <= 90)), count((b >= 97) & (b <= 122))
    digits, high = count((b >= 48) & (b <= 57)), count(b >= 128)
    marks = size - upper - lower - digits - high
    again = np.zeros(len(size), dtype=np.int64)
    for k in (1, 2):
        again[k:] |= (w.hash[k:] == w.hash[:-k]) & (w.doc[k:] == w.doc[:-k])
    last = b[w.end - 1] if len(size) else np.zeros(0, np.uint8)
    last = np.where(((last >= 48) & (last <= 57)) | (last >= 128) | ((last | 32 >= 97) & (last | 32 <= 122)), 0, last)
    shape = np.minimum(upper, 2)
    for value, base in ((np.minimum(lower, 1), 2), (np.minimum(digits, 2), 3), (np.minimum(marks, 3), 4), (np.digitize(size, [2, 3, 5, 8, 13, 21]), 7), (again, 2), (last, 256)):
        shape = shape * base + value
    out = np.empty(2 * len(size), dtype=np.uint64)
    out[::2], out[1::2] = mix(shape.astype(np.uint64) + np.uint64(77)), w.hash
    return out, w


def index_vectors(h: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Place and sign of each of the SIGNS entries of each token's index vector."""
    x = mix(h ^ np.uint64(0xABCDEF))
    return [((x >> np.uint64(8 * k)) % np.uint64(DIMS), 1.0 - 2.0 * (x >> np.uint64(60 + k) & np.uint64(1))) for k in range(SIGNS)]


@trimmed
def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(ROWS * DIMS)
    for batch in batches:
        b, offs = utf8(batch.column(0))
        for i, j in chunks(offs):
            h, w = tokens(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            doc = np.repeat(w.doc, 2)
            row = (h & np.uint64(ROWS - 1)).astype(np.int64) * DIMS
            flat, sign = [], []
            for place, s in index_vectors(h):
                place = place.astype(np.int64)
                for k in (1, 2):
                    same = doc[k:] == doc[:-k]
                    flat += [(row[k:] + place[:-k])[same], (row[:-k] + place[k:])[same]]
                    sign += [s[:-k][same], s[k:][same]]
            if len(h):
                total += np.bincount(np.concatenate(flat), np.concatenate(sign), minlength=len(total))
    t = total.reshape(ROWS, DIMS).astype(np.int64)
    k = np.flatnonzero(t.any(1))
    yield pa.record_batch([pa.array(k), pa.FixedSizeListArray.from_arrays(pa.array(t[k].ravel()), DIMS).cast(pa.list_(pa.int64()))], ["row", "v"])


@trimmed
def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for g in groups(batches, ["row"]):
        v = g["v"].combine_chunks().flatten().to_numpy().reshape(-1, DIMS).sum(0)
        yield pa.record_batch([g["row"].combine_chunks().slice(0, 1), pa.array([v.tolist()], pa.list_(pa.int64()))], ["row", "v"])


def word_vectors(docs: DataFrame, text_col: str) -> np.ndarray:
    part = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_contexts, "row long, v array<long>")
    rows = part.repartition("row").sortWithinPartitions("row").mapInArrow(_added, "row long, v array<long>").toPandas()
    out = np.zeros((ROWS, DIMS), dtype=np.float32)
    if len(rows):
        out[rows["row"].to_numpy(np.int64)] = np.stack(rows["v"].to_list())
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def features(b: np.ndarray, offs: np.ndarray, table: np.ndarray) -> np.ndarray:
    h, w = tokens(b, offs)
    out = np.zeros((w.n_docs, FEATURES), dtype=np.float32)
    out[:, -1] = np.log1p(w.count) / 5
    full = np.flatnonzero(w.count)
    if len(full):
        n = w.count[full, None]
        for k in (0, 1):
            v = table[(h[k::2] & np.uint64(ROWS - 1)).astype(np.int64)]
            mean = np.add.reduceat(v, w.first[full], axis=0) / n
            square = np.add.reduceat(v * v, w.first[full], axis=0) / n
            out[full, 2 * k * DIMS : (2 * k + 1) * DIMS] = mean
            out[full, (2 * k + 1) * DIMS : (2 * k + 2) * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


def gradients(p: list, z: np.ndarray, y: np.ndarray, decay: float = 1e-4) -> list:
    """Of the mean log loss, and decay / 2 times the squared weights, by the two layers' weights and biases p."""
    hidden = np.tanh(z @ p[0] + p[1])
    d = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - y) / len(y)
    back = np.outer(d, p[2]) * (1 - hidden * hidden)
    return [z.T @ back + decay * p[0], back.sum(0), hidden.T @ d + decay * p[2], d.sum()]


class Network:
    """Standardised features, HIDDEN tanh units, one logit over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 1):
        share = float(y.mean()) if len(y) else 0.5
        self.constant = share if len(np.unique(y)) < 2 else None
        if self.constant is not None:
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        cut = max(1, len(x) // 10)
        test, warm, train = order[:cut], order[cut : 2 * cut], order[2 * cut :]
        if not len(train):  # two or three documents: all serve for all
            test = warm = train = order
        self.mean, self.std = x[train].mean(0), x[train].std(0) + 1e-3
        z = (x - self.mean) / self.std
        self.p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.log(share / (1 - share))]
        m, v, best, step = [0.0] * 4, [0.0] * 4, (np.inf, self.p), 0
        for _epoch in range(60):
            train = rng.permutation(train)
            for i in range(0, len(train), 256):
                k = train[i : i + 256]
                step += 1
                for q, g in enumerate(gradients(self.p, z[k], y[k])):
                    m[q] = 0.9 * m[q] + 0.1 * g
                    v[q] = 0.999 * v[q] + 0.001 * g * g
                    self.p[q] = self.p[q] - 3e-3 * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.999**step)) + 1e-8)
            loss = self._loss(z[test], y[test], 1.0)
            if loss < best[0]:
                best = (loss, list(self.p))
        self.p = best[1]
        self.temperature = min((0.25 * 1.1**k for k in range(30)), key=lambda t: self._loss(z[warm], y[warm], t))

    def _logit(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def _loss(self, z: np.ndarray, y: np.ndarray, t: float) -> float:
        return float(np.logaddexp(0, -np.where(y > 0.5, 1, -1) * self._logit(z) / t).mean())

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.std) / self.temperature, -30, 30)))


def _features(shared):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offs = utf8(batch.column(1))
            for i, j in chunks(offs):
                x = features(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i], shared.value)
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(x.tolist(), pa.list_(pa.float32()))], ["y", "x"])

    return run


def _score(shared, network):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offs = utf8(batch.column(1))
            for i, j in chunks(offs):
                s = network.score(features(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i], shared.value))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(s, pa.float64())], ["x", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row per document: id, held_out (crc32 of the id mod 5 = 0: its label is not learned from), score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text_col))
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), 0)).groupBy(F.col(id_col).alias("i")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("i"), "i").limit(SAMPLE)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "i")
    rows = rows.groupBy("i").agg(F.min("y").alias("y"), F.min("text").alias("text")).select("y", "text")
    rows = rows.mapInArrow(_features(shared), "y int, x array<float>").toPandas()
    x = np.stack(rows["x"].to_list()).astype(np.float64) if len(rows) else np.zeros((0, FEATURES))
    y = rows["y"].to_numpy(np.float64)
    order = np.lexsort((y, *x.T[:4]))  # reruns agree, whatever order the rows came in
    network = Network(x[order], y[order])
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("x"), F.col(text_col).cast("string").alias("text")).mapInArrow(_score(shared, network), f"x {kind}, score double")
    return out.select(F.col("x").alias(id_col), held_out(F.col("x"), 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
