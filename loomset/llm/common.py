"""Shared pieces: table access, vectorised tokenising, grouping of sorted Arrow batches, connected components."""

from __future__ import annotations

import ctypes
import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomset.scratch import drop, stash_path

CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Byte classes of the two word definitions.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(run):
    """A function for mapInArrow that gives its memory back to the system at its end, as workers live on for later stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return wrapped


_OBJECT = "loomset object"


def plain(x):
    """An object of this package as names and values, to be broadcast: executors need not import its class."""
    return (_OBJECT, type(x).__name__, {k: plain(v) for k, v in vars(x).items()}) if type(x).__module__.startswith("loomset.") else x


def whole(x, *classes: type):
    """The object again, of the classes given; arrays are not copied."""
    if not (isinstance(x, tuple) and x[:1] == (_OBJECT,)):
        return x
    out = object.__new__(next(c for c in classes if c.__name__ == x[1]))
    out.__dict__.update({k: whole(v, *classes) for k, v in x[2].items()})
    return out


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    b = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and len(arr) else np.zeros(0, np.uint8)
    return b, offs - offs[0] if len(arr) else np.zeros(1, np.int64)


def chunks(offs: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about `size` bytes; a longer document is a run of its own."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Keys of the hash of words, and masks of the first bytes of eight.
_KEY = [np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0x3C79AC492BA7B653, 0x1C69B3F74AC4AE35)]
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
LONG = 256

_R = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _R and of its inverse, kept for the life of the process and never sent with a task."""
    kept = sys.modules.setdefault("_loomset_powers", types.ModuleType("_loomset_powers")).__dict__
    if len(kept.get("p", ())) < n:
        for k, r in (("p", _R), ("q", pow(_R, -1, 1 << 64))):
            a = np.full(n, np.uint64(r), dtype=np.uint64)
            a[0] = 1
            kept[k] = np.multiply.accumulate(a)
    return kept["p"], kept["q"]


def lanes(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of b on as an integer; beyond its end are zeros."""
    pad = np.zeros(len(b) + 8, dtype=np.uint8)
    pad[: len(b)] = b
    return np.ndarray(len(b) + 1, dtype="<u8", buffer=pad, strides=(1,))


class Words:
    """Words of a run of documents: start and end byte, document, and 64-bit hash of the lower-cased (A-Z) bytes."""

    def __init__(self, b: np.ndarray, offs: np.ndarray, word: np.ndarray = SPACED, hashes: bool = True):
        self.low = low = _LOWER[b]
        m = word[low]
        self.n_docs = len(offs) - 1
        edge = np.zeros(len(b) + 1, dtype=bool)
        edge[offs] = True
        before = np.zeros(len(b), dtype=bool)
        before[1:] = m[:-1]
        after = np.zeros(len(b), dtype=bool)
        after[:-1] = m[1:]
        self.start = np.flatnonzero(m & (~before | edge[:-1]))
        self.end = np.flatnonzero(m & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(offs, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.zeros(self.n_docs + 1, dtype=np.int64)
        np.cumsum(self.count, out=self.first[1:])
        if hashes:
            self.hash = self._hash(low)

    def _hash(self, low: np.ndarray) -> np.ndarray:
        """Eight bytes at a time, each through a bijection of what came before; words over LONG bytes by BLAKE2."""
        size = self.end - self.start
        lane = lanes(low)
        out = mix(size.astype(np.uint64) * _KEY[0] + _KEY[1])
        k = np.flatnonzero(size <= LONG) if len(size) and size.max() > LONG else None
        at, left = (self.start, size) if k is None else (self.start[k], size[k])
        h = out if k is None else out[k]
        while len(at):
            now = mix((h ^ (lane[at] & _MASK[np.minimum(left, 8)])) * _KEY[2])
            if k is None:
                out = now
            else:
                out[k] = now
            more = np.flatnonzero(left > 8)
            k = more if k is None else k[more]
            at, left, h = at[more] + 8, left[more] - 8, now[more]
        for w in np.flatnonzero(size > LONG):
            out[w] = int.from_bytes(hashlib.blake2b(self.text(w), digest_size=8, key=b"loomset").digest(), "little")
        return out

    def text(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether the words i of a and j of b, pair by pair, are the same bytes."""
    size = a.end[i] - a.start[i]
    same = size == b.end[j] - b.start[j]
    live = np.flatnonzero(same)
    for k in live[size[live] > 1 << 12]:
        same[k] = a.text(i[k]) == b.text(j[k])
    live = live[size[live] <= 1 << 12]
    x, y, at = lanes(a.low), lanes(b.low), 0
    while len(live):
        left = _MASK[np.minimum(size[live] - at, 8)]
        ok = ((x[a.start[i[live]] + at] ^ y[b.start[j[live]] + at]) & left) == 0
        same[live[~ok]] = False
        at += 8
        live = live[ok & (size[live] > at)]
    return same


_SHINGLE = [np.uint64(x | 1) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def roll(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes, document borders ignored; length len - n + 1."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        out = mix(out * _SHINGLE[i % 5] + hashes[i : i + m])
    return out


def shingle_sets(w: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each document; shorter documents have one for the whole sequence."""
    run, out = roll(w.hash, n), []
    for d in range(w.n_docs):
        a, b = w.first[d], w.first[d + 1]
        if b - a >= n:
            out.append(np.unique(run[a : b - n + 1]))
        else:
            out.append(roll(w.hash[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], sized: str, size: int) -> Iterator[pa.Table]:
    """Tables of whole groups of equal keys with about `size` bytes in column `sized`; batches are sorted by the keys."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        at = 0
        ends = np.cumsum(pa.compute.binary_length(batch[sized]).to_numpy())
        while at < batch.num_rows:  # in steps, so that one large batch is cut too
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size - min(held_bytes, size), side="right")))
            to = min(to, batch.num_rows)
            held.append(batch.slice(at, to - at))
            held_bytes += int(ends[to - 1] - done)
            at = to
            if held_bytes < size:
                continue
            t = pa.Table.from_batches(held)
            change = np.zeros(t.num_rows, dtype=bool)
            for k in keys:
                c = t[k].to_numpy()
                change[1:] |= c[1:] != c[:-1]
            if len(cut := np.flatnonzero(change)):
                yield t.slice(0, cut[-1])
                held = t.slice(cut[-1]).combine_chunks().to_batches()
                held_bytes = int(pa.compute.sum(pa.compute.binary_length(held[0][sized])).as_py())
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs -> (node, component), component the smallest node reachable; only nodes that have an edge.

    Alternating large-star and small-star steps until all edges are stars around smallest nodes. A node's neighbours are
    never gathered: each step is a minimum per node (summed before the shuffle) and an equi-join that AQE may split. Each step is
    written to the shared folder, and the one before it deleted. Nodes that are no star yet are counted while the minima of a
    round are written. Pairs with u = v or a null are dropped.
    """
    spark = edges.sparkSession
    edge = "u long, v long"
    path = stash_path(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    while True:
        e = spark.read.schema(edge).parquet(path)
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") < F.col("u")).alias("below"), F.count_if(F.col("v") > F.col("u")).alias("above"))
        open_ = Observation()
        low = low.observe(open_, F.count_if(F.expr("below > 1 or (below = 1 and above > 0)")).alias("n"))
        # minima are written first, so that each join has two plain shuffles and AQE can split the one of a hot node
        low_path = stash_path(low.select("u", F.least("u", "m").alias("m")), "cc-low")
        if not open_.get["n"]:
            drop(spark, low_path)
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
        low = spark.read.schema("u long, m long").parquet(low_path)
        large_path = stash_path(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), "cc")
        drop(spark, path)
        drop(spark, low_path)
        e = spark.read.schema(edge).parquet(large_path)
        low_path = stash_path(e.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        low = spark.read.schema("u long, m long").parquet(low_path)
        e = e.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        path = stash_path(e, "cc")
        drop(spark, large_path)
        drop(spark, low_path)
