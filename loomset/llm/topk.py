"""Exact top-k search by inner product with Fagin's threshold algorithm over sorted per-dimension lists.

Components are quantised to floor(scale * x). Within a block of candidates each dimension has its list of candidates sorted by
value. A query reads a list from its best end: the top where its component is positive, the bottom where it is negative. A
candidate that is met in any list is scored in full, and no other. The score that a candidate not yet met could have is at most
the sum of the query's components times the next value of each list; once that is below the kth best score known, no unread
entry can matter and the block is done. Lists are not read to equal depth: the next entries are always those that lower the
bound most for each entry read (Lists.plan), so lists of small components are hardly read.

The kth best score is global: a first pass searches one block for all queries, and the kth score of each goes with it to the
other blocks. There a block whose bound is below it before anything is read is left out, and only scores that reach it are given.

Scale: candidates and queries are dealt into blocks by hash, and each pair of blocks is a task's group of bounded size, as
the task asks for every query against every row. A block gives at most k rows for each query, of which a window keeps k.

Nulls and edge cases: vectors that are null or hold a null or non-finite component, and rows with a null id, take no part.
Vectors of any finite size do: where a score could pass 2^53 it is made of integers, of any length where it could pass 2^62,
and a score beyond a long counts as the long's end. Rows that have the query's id are its own and are left out; other repeated rows
are candidates each. Queries of one id with different vectors are queries of their own, equal ones are one. Shorter vectors are
filled with zeros. Ties go to the smaller id. Empty tables give an empty result. Only id and vector are read, so further columns
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import groups
from loomset.scratch import stash

BLOCK, QUERIES, BATCH = 8192, 2048, 64
LONGEST = (1 << 63) - 1


class Lists:
    """The sorted lists of a block of candidates. x: whole numbers as floats, of which every score is a float exactly."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.n, self.dims = x.shape
        up = np.argsort(self.x, axis=0, kind="stable")
        rank = np.empty(up.shape, dtype=np.int32)
        np.put_along_axis(rank, up, np.arange(self.n, dtype=np.int32)[:, None], axis=0)
        self.rank = np.ascontiguousarray(rank.T)
        value = np.take_along_axis(self.x, up, axis=0)
        self.depths = np.concatenate([[0], 1 << np.arange(2, 62)])
        self.depths = self.depths[self.depths < self.n]
        self.top, self.bottom = value[self.n - 1 - self.depths], value[self.depths]  # the next entry's value at each depth
        self.asked = self.scored = self.stopped = 0  # query and candidate pairs; queries that stopped before the end

    def plan(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, how deep to read each list until the bound is below `least`, and whether it ever is."""
        q = q.astype(np.float64)
        bound = np.where((q > 0)[:, None], q[:, None] * self.top, q[:, None] * self.bottom)  # query, depth, dimension
        drop = bound[:, :-1] - bound[:, 1:]
        rate = np.minimum.accumulate(drop / np.diff(self.depths)[:, None], axis=1)  # so that each list is read in order
        order = np.argsort(-rate.reshape(len(q), -1), axis=1, kind="stable")
        left = bound[:, 0].sum(1)[:, None] - np.cumsum(np.take_along_axis(drop.reshape(len(q), -1), order, 1), axis=1)
        left = np.concatenate([bound[:, 0].sum(1)[:, None], left], axis=1)
        done = left < least[:, None]  # a tie may go to a smaller id that is not met
        steps = np.where(done.any(1), done.argmax(1), order.shape[1])
        level = np.zeros((len(q), self.dims), dtype=np.int64)
        for r in range(len(q)):
            level[r] = np.bincount(order[r, : steps[r]] % self.dims, minlength=self.dims)
        return self.depths[level], done.any(1)

    def met(self, q: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The candidates that stand among the first entries of any list."""
        out = np.zeros((len(q), self.n), dtype=bool)
        for r in range(len(q)):
            for d in np.flatnonzero(depth[r]):
                if q[r, d] > 0:
                    out[r] |= self.rank[d] >= self.n - depth[r, d]
                elif q[r, d] < 0:
                    out[r] |= self.rank[d] < depth[r, d]
        return out

    def scores(self, q: np.ndarray, met: np.ndarray) -> np.ndarray:
        """Scores of the candidates that were met, minus infinity for the others."""
        out = np.full(met.shape, -np.inf, dtype=self.x.dtype)
        self.scored += int(met.sum())
        if met.mean() > 0.25:  # one product of all that some query of the batch met is cheaper than many look-ups
            some = np.flatnonzero(met.any(1))
            any_ = np.flatnonzero(met.any(0))
            part = q[some] @ (self.x if len(any_) == self.n else self.x[any_]).T
            out[np.ix_(some, any_)] = np.where(met[np.ix_(some, any_)], part, -np.inf)
        else:
            for r in range(len(q)):
                c = np.flatnonzero(met[r])
                out[r, c] = self.x[c] @ q[r]
        return out

    def search(self, own: np.ndarray, q: np.ndarray, k: int, least: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its place, and the ids and scores of its k best of this block that reach `least`."""
        for i in range(0, len(q), BATCH):
            part = q[i : i + BATCH]
            barred = self.ids[None, :] == own[i : i + BATCH, None]
            floor = np.full(len(part), -np.inf) if least is None else least[i : i + BATCH].astype(np.float64)
            best = None
            if not np.isfinite(floor).all() and len(self.depths) > 2:  # the first entries of all lists give a first kth score
                met = self.met(part, np.full(part.shape, self.depths[2]))
                best = np.where(barred, -np.inf, self.scores(part, met))
                floor = np.maximum(floor, self._kth(best, k))
            depth, stops = self.plan(part, floor)
            met = self.met(part, np.where(stops[:, None], depth, 0))
            met[~stops] = True
            if best is not None:
                met &= best == -np.inf
            now = np.where(barred, -np.inf, self.scores(part, met))
            best = now if best is None else np.maximum(best, now)
            self.asked += best.size
            self.stopped += int(stops.sum())
            floor = np.maximum(floor, self._kth(best, k))
            for r in range(len(part)):
                c = np.flatnonzero((best[r] >= floor[r]) & (best[r] > -np.inf))
                c = c[np.argsort(-best[r, c], kind="stable")][:k]  # ids ascend
                yield i + r, self.ids[c], best[r, c].astype(np.int64)

    def _kth(self, score: np.ndarray, k: int) -> np.ndarray:
        return np.partition(score, self.n - k, axis=1)[:, self.n - k] if self.n >= k else np.full(len(score), -np.inf)


def _all(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As Lists.search, for numbers too large for it: x and q are integers or, where these could overflow, objects."""
    for r in range(len(q)):
        c = np.flatnonzero(ids != own[r])
        s = x[c] @ q[r]
        if s.dtype == object:
            s = np.array([max(-LONGEST - 1, min(LONGEST, v)) for v in s], dtype=np.int64)
        order = np.lexsort((ids[c], ~s))[:k]
        yield r, ids[c][order], s[order]


def _matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    col = col.combine_chunks()
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == dims).all():
        return flat.reshape(len(col), dims)
    out = np.zeros((len(col), dims))
    at = np.repeat(np.arange(len(col)), size)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as floats; as Python integers where a float can't hold it."""
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if np.isfinite(y).all():
        return y
    return np.array([[int(v) * scale if abs(v) > 2.0**60 else int(np.floor(scale * v)) for v in row] for row in x.tolist()], dtype=object)


def _search(k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["block", "ask"]):
            asked = g["is_query"].to_numpy().astype(bool)
            if asked.all() or not asked.any():
                continue
            dims = max(1, int(np.diff(g["v"].combine_chunks().offsets.to_numpy()).max()))
            x, ids = quantised(_matrix(g["v"], dims), scale), g["id"].to_numpy()
            key = g["key"].to_numpy()[asked]
            most = np.inf if x.dtype == object else float(abs(x[~asked]).max()) * float(abs(x[asked]).max()) * dims
            own = ids[asked]
            if most < 2**53:
                exact = x.astype(np.float32 if most < 2**24 else np.float64)
                found = Lists(ids[~asked], exact[~asked]).search(own, exact[asked], k, g["least"].to_numpy()[asked])
            else:
                if most < 2**62:
                    x = x.astype(np.int64)
                elif x.dtype != object:
                    x = np.array([[int(v) for v in row] for row in x.tolist()], dtype=object)
                found = _all(ids[~asked], x[~asked], own, x[asked], k)
            rows = [(np.full(len(i), own[r]), np.full(len(i), key[r]), i, s) for r, i, s in found]
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], ["query_id", "key", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of vectors with the highest scores for each row of queries."""

    def rows(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
        return df.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)

    c, q = rows(vectors), rows(queries).withColumn("key", F.xxhash64("id", "v")).dropDuplicates(["id", "key"])
    blocks, asks = (max(1, -(-df.count() // size)) for df, size in ((c, BLOCK), (q, QUERIES)))
    none = F.lit(None)
    c = c.select("id", "v", F.lit(0).alias("is_query"), F.lit(0).cast("long").alias("key"), none.cast("double").alias("least"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.explode(F.expr(f"sequence(0L, {asks - 1}L)")).alias("ask"))

    def searched(least: DataFrame | None, first: int, last: int) -> DataFrame:
        ask = q if least is None else q.join(least, (q.id == least.query_id) & (q.key == least.k), "left")
        ask = ask.select("id", "v", F.lit(1).alias("is_query"), "key", (none.cast("double") if least is None else F.col("least")).alias("least"), F.explode(F.expr(f"sequence({first}L, {last}L)")).alias("block"), F.pmod(F.xxhash64("key"), F.lit(asks)).alias("ask"))
        ask = ask.withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        part = c.where(F.col("block").between(first, last)).withColumn("least", F.lit(0.0))
        return part.unionByName(ask).repartition("block", "ask").sortWithinPartitions("block", "ask").mapInArrow(_search(k, scale), "query_id long, key long, vec_id long, score long")

    found = stash(searched(None, 0, 0), "first-block")
    if blocks > 1:
        least = found.groupBy("query_id", F.col("key").alias("k")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least")).where(f"n = {k}").drop("n")
        found = found.union(searched(least, 1, blocks - 1))
    best = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = r"""
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, unnest(e) AS e, generate_subscripts(e, 1) AS d FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(floor(64 * q.e::DOUBLE)::BIGINT * floor(64 * c.e::DOUBLE)::BIGINT)::BIGINT AS score
    FROM x q JOIN x c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
