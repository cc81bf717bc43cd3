"""MinHash near-duplicate linking with min-max hashing.

Each permutation is evaluated once per shingle and keeps both its minimum and its maximum, so 64 evaluations give a
signature of 128 values. 32 bands of 4 values (both ends of two permutations) find a pair of Jaccard similarity s with
probability 1 - (1 - s^4)^32: at 0.8 all but 5 in 10^8. Every proposed link is confirmed on the full shingle sets.

How groups stay small:

1. Equal sets (copies included) fold into their smallest id before anything is exchanged.
2. Buckets of up to BUCKET sets link members whose signature estimate is at least threshold - 0.18 (5 standard deviations).
   Larger ones (boilerplate, or one great group of copies) are dealt again, by the band's value and that of one of the next
   SECOND bands: two sets of similarity 0.8 share 13 bands on average, and two within that reach but for 2 in 10^5. Only buckets
   that are large again link each member to their smallest id, a superset. The closure of these linear many pairs gives candidate
   groups that contain each true link.
3. A candidate group of up to GROUP sets is confirmed all against all in one task. A larger one is dealt over blocks of
   BLOCK sets: each block is confirmed within itself and against about LEADERS sets of the whole group; then every set
   that is not yet in the group's largest component (a straggler) is compared with all blocks, by sketches of 64 bytes, and
   confirmed where a sketch is near enough; sets go to those blocks alone. Pairs within the largest component need no test, as
   they cannot change a component. No link between different texts is lost, and no task holds more than a block and a chunk
   of stragglers.

Nulls and edge cases: null or wordless texts have an empty set and are linked with nothing. Rows with a null id take no
part: component null, kept true. Rows with the same id are one node, whatever their texts. Shorter texts than a
shingle are one shingle. Very long texts are read whole. An empty table gives an empty result. Only id and text are read, so
further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import chunks, connected_components, groups, shingle_sets, trimmed, utf8, Words
from loomset.scratch import stash

PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
BUCKET, SECOND, GROUP, BLOCK, LEADERS, STRAGGLERS = 256, 8, 256, 128, 16, 64
#: How far below the threshold an estimate may be.
SLACK = 0.18


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607)
    return r.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """2 * PERMUTATIONS values for each non-empty set: minimum and maximum of each permutation, side by side."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), 2 * PERMUTATIONS), dtype=np.uint64)
    for k, (a, b) in enumerate(zip(*_permutations(), strict=True)):
        x = flat * a + b
        out[:, 2 * k] = np.minimum.reduceat(x, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(x, starts)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.empty((len(sig), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        h = np.full(len(sig), np.uint64(band + 1), dtype=np.uint64)
        for v in range(band * ROWS, band * ROWS + ROWS):
            h = (h ^ sig[:, v]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(29)
        keys[:, band] = h
    return keys.view(np.int64)


def nibbles(sig: np.ndarray) -> np.ndarray:
    """4 bits of each signature value, two to a byte, to estimate similarity with."""
    x = ((sig * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(60)).astype(np.uint8)
    return x[:, ::2] << 4 | x[:, 1::2]


def _sketch(n: int, bands: bool):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offs = utf8(batch.column(1))
            for i, j in chunks(offs):
                o = offs[i : j + 1] - offs[i]
                sets = shingle_sets(Words(b[offs[i] : offs[j]], o), n)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                ids = batch.column(0).slice(i, j - i)
                if not bands:
                    yield pa.record_batch([ids, pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])
                    continue
                full = np.flatnonzero(size)
                name = np.full(len(sets), None, dtype=object)
                keys = np.full(len(sets), None, dtype=object)
                sketch = np.full(len(sets), None, dtype=object)
                if len(full):
                    sig = signatures([sets[k] for k in full])
                    bk, nib = band_keys(sig), nibbles(sig)
                    for r, k in enumerate(full):
                        name[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                        keys[k], sketch[k] = bk[r], nib[r].tobytes()
                yield pa.record_batch([ids, pa.array(size), pa.array(name, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())], ["id", "size", "name", "bands", "sketch"])

    return run


def estimates(x: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Similarity of sketches x to one, corrected for nibbles that agree by chance."""
    d = x ^ one
    same = ((d & 15 == 0).sum(1) + (d >> 4 == 0).sum(1)) / (2 * x.shape[1])
    return (same - 1 / 16) * 16 / 15


def _sketches(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint8).reshape(len(col), -1)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _alike(least: float):
    """Within each small bucket, a spanning forest of the pairs whose estimate is high enough."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for g in groups(batches, ["band", "key"]):
            ids = g["id"].to_numpy()
            if len(ids) == 1:
                continue
            x = _sketches(g["sketch"])
            f = Forest(len(ids))
            for i in range(len(ids) - 1):
                for j in np.flatnonzero(estimates(x[i + 1 :], x[i]) >= least) + i + 1:
                    if f.join(i, int(j)):
                        u.append(ids[i])
                        v.append(ids[j])
            if len(u) > 50_000:
                yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
                u, v = [], []
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def confirmed(sets: list[np.ndarray], percent: int, rows: range | None = None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs whose exact similarity is percent / 100 or more; rows: only pairs with one of these."""
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * both >= percent * (size.sum() - both):
            yield 0, 1
        return
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    mark, f = np.zeros(len(values), dtype=np.int32), Forest(len(sets))
    for i in rows or range(len(sets)):
        own = at[starts[i] : starts[i] + size[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[at], starts)
        mark[own] = 0
        for j in np.flatnonzero(100 * both >= percent * (size + size[i] - both)):
            if f.join(i, int(j)):
                yield i, int(j)


def _confirm(keys: list[str], percent: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for g in groups(batches, keys):
            if g.num_rows == 1:
                continue
            if "ask" in g.column_names:  # stragglers first
                g = g.sort_by([("ask", "descending")])
                rows = range(int(sum(g["ask"].to_pylist())))
            else:
                rows = None
            ids = g["id"].to_numpy()
            sets = [np.frombuffer(s, dtype=np.uint64) for s in g["shingles"].to_pylist()]
            for i, j in confirmed(sets, percent, rows):
                u.append(ids[i])
                v.append(ids[j])
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


EDGE = "u long, v long"


def _sorted(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _worth(keys: list[str], least: float):
    """Of stragglers (ask = 1) and a block, those that have a sketch near enough on the other side."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, keys):
            ask, ids, x = g["ask"].to_numpy() == 1, g["id"].to_numpy(), _sketches(g["sketch"])
            block, wanted = np.flatnonzero(~ask), np.zeros(len(ids), dtype=bool)
            for i in np.flatnonzero(ask):
                near = block[(estimates(x[block], x[i]) >= least) & (ids[block] != ids[i])]
                wanted[near] = True
                wanted[i] = len(near) > 0
            if wanted.any():
                yield from g.select(["id", *keys, "ask"]).filter(pa.array(wanted)).to_batches()

    return run


def _large_groups(sets: DataFrame, sketches: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """The links of candidate groups of more than GROUP sets; label: components by what was confirmed within blocks and with leaders."""
    nodes = sets.select("id", "comp", "blocks", "block")
    part = nodes.join(label, nodes.id == F.col("node"), "left").select("id", "comp", "blocks", F.coalesce("component", "id").alias("part"))
    sizes = part.groupBy("comp", "part").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("comp").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("all"))
    rest = part.join(largest, "comp").where("part <> top.part").select("id", "comp", F.expr(f"cast(ceil((all - top.n) / {STRAGGLERS}.0) as long)").alias("chunks"))
    rest = stash(rest, "stragglers")
    light = nodes.join(sketches, "id")
    asked = light.join(rest.select("id", "chunks"), "id").select("id", "comp", "sketch", F.expr("pmod(xxhash64(id, 7), chunks)").alias("chunk"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(1).alias("ask"))
    many = rest.select("comp", "chunks").distinct()
    against = light.join(many, "comp").select("id", "comp", "sketch", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), "block", F.lit(0).alias("ask"))
    keys = ["comp", "chunk", "block"]
    worth = _sorted(asked.unionByName(against), keys).mapInArrow(_worth(keys, percent / 100 - SLACK), "id long, comp long, chunk long, block long, ask int")
    return _sorted(stash(worth, "worth").join(sets.select("id", "shingles"), "id"), keys).mapInArrow(_confirm(keys, percent), EDGE)


def _candidates(first: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets (id, bands, sketch) whose closure holds each link."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        full = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("id").alias("low")).where("n > 1")
        return stash(rows.join(full, ["band", "key"]), name)

    def near(rows: DataFrame) -> DataFrame:
        small = rows.where(f"n <= {BUCKET}").select("band", "key", "id").join(first.select("id", "sketch"), "id")
        return _sorted(small, ["band", "key"]).mapInArrow(_alike(percent / 100 - SLACK), EDGE)

    rows = counted(first.select("id", F.posexplode("bands").alias("band", "key")), "bands")
    pairs = near(rows)
    large = rows.where(f"n > {BUCKET}")
    if large.isEmpty():
        return pairs
    other = F.expr(f"transform(sequence(1, {SECOND}), j -> xxhash64(band, key, j, bands[(band + j) % {BANDS}]))")
    again = counted(large.select("id", "band", "key").join(first.select("id", "bands"), "id").select("id", "band", F.explode(other).alias("key")), "bands-again")
    stars = again.where(f"n > {BUCKET} and id <> low").select(F.col("low").alias("u"), F.col("id").alias("v"))
    return pairs.union(near(again)).union(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links), kept (is it the smallest).

    words: words of a shingle. percent: documents are linked if 100 * |A & B| >= percent * |A | B|. See the module's text.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = stash(docs.mapInArrow(_sketch(words, True), "id long, size long, name binary, bands array<long>, sketch binary"), "sketches")
    live = seen.where("id is not null and size > 0")
    first = stash(live.groupBy("name").agg(F.min("id").alias("id"), F.min_by(F.struct("bands", "sketch"), "id").alias("x")).select("name", "id", "x.*"), "sets")
    copies = live.select("name", F.col("id").alias("v")).join(first.select("name", F.col("id").alias("u")), "name").where("u <> v").select("u", "v")

    group = connected_components(_candidates(first, percent)).select(F.col("node").alias("id"), F.col("component").alias("comp"))

    size = group.groupBy("comp").agg(F.count("*").alias("n"))
    member = group.join(size, "comp").withColumn("blocks", F.expr(f"if(n <= {GROUP}, 1L, cast(ceil(n / {BLOCK}.0) as long))")).withColumn("block", F.expr("pmod(xxhash64(id), blocks)"))
    member = stash(member, "groups")
    sets = docs.join(member, "id").select("id", "text", "comp", "n", "blocks", "block")
    stashed = stash(_with_sets(sets, words), "members")
    lead = stashed.where(f"blocks > 1 and (xxhash64(id, 3) & 4294967295L) < 4294967296L * {LEADERS} / n")
    spread = lead.select("id", "comp", "shingles", "n", "blocks", F.col("block").alias("own"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block")).where("block <> own").drop("own")
    keys = ["comp", "block"]
    found = stash(_sorted(stashed.unionByName(spread).select("id", "shingles", *keys), keys).mapInArrow(_confirm(keys, percent), EDGE), "links")
    links = found
    large = stashed.where("blocks > 1")
    if not large.isEmpty():
        label = connected_components(found)
        links = label.select(F.col("node").alias("u"), F.col("component").alias("v")).union(_large_groups(large, first.select("id", "sketch"), label, percent))
    links = links.union(copies)
    label = connected_components(links)
    return (
        seen.join(label, seen.id == label.node, "left")
        .select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )


def _with_sets(sets: DataFrame, words: int) -> DataFrame:
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            rest = batch.select(["comp", "n", "blocks", "block"])
            for out in _sketch(words, False)(iter([batch.select(["id", "text"])])):
                part = rest.slice(at, out.num_rows)
                at += out.num_rows
                yield pa.record_batch([*out.columns, *part.columns], [*out.schema.names, *rest.schema.names])

    return sets.mapInArrow(run, "id long, shingles binary, comp long, n long, blocks long, block long")
