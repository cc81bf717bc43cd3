"""Benchmark decontamination as a prefix-filtered set join.

Each benchmark item is cut into windows of `words` consecutive words (a shorter item is one window). A window is
contained in a document only if all its words are, so by the prefix principle one word is necessary: words are ordered
by rarity over all documents, and each window is indexed under its rarest word alone. A document probes with those
of its words that are some window's rarest. The bounds follow at once: length, since the window must lie within the
document; and position, since the word's offset in the window fixes where the window would start. Each survivor is
verified: the window's words are compared at that place, first by 64-bit hashes, then byte by byte, all of them.

Scale: documents are never shuffled. Rarity is counted once, over all documents, in a table of SLOTS counts by hash (words that
share a slot share a rank, which changes the order and no result), summed before the shuffle. The benchmark is dealt into
blocks of about BLOCK_WORDS words, so that what is broadcast is bounded for any benchmark; an item beyond PIECE words is cut
into pieces that overlap by a window less a word. Each block is one pass over the documents, and a row carries what was hit
from pass to pass, so rows need no identity. The driver holds a block at a time, and one item's text.

Nulls and edge cases: null or wordless items have no window; null or wordless documents have no words and no hits. Items
with a null id mark words but have no id to list. Repeated item ids count once; repeated documents are rows of their own.
An empty benchmark or document table gives clean documents or no rows. Very long texts are read whole. Only id and text are
read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import ALNUM, chunks, plain, same_words, trimmed, utf8, whole, Words
from loomset.scratch import stash

#: Words of a benchmark block (about 100 MB broadcast), words of an item's piece, and slots of the table of rarity.
BLOCK_WORDS, PIECE, SLOTS = 1 << 20, 1 << 16, 1 << 20


def _words_of(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, Words]]:
    b, offs = utf8(batch.column(text))
    for i, j in chunks(offs):
        yield i, j, Words(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i], ALNUM)


def _found(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each x stands in sorted_values, and whether it is there."""
    at = np.minimum(np.searchsorted(sorted_values, x), max(len(sorted_values) - 1, 0))
    return at, (sorted_values[at] == x if len(sorted_values) else np.zeros(len(x), dtype=bool))


class Member:
    """Membership of 64-bit hashes: a bit table of their low bits turns most away before the binary search."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = max(16, int(len(self.values)).bit_length() + 4)
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[(self.values & np.uint64((1 << self.bits) - 1)).astype(np.int64)] = True

    def where(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in x of members, and their places in values."""
        at = np.flatnonzero(self.seen[(x & np.uint64((1 << self.bits) - 1)).astype(np.int64)])
        place, ok = _found(self.values, x[at])
        return at[ok], place[ok]


class Index:
    """The windows of one block under their rarest words. ids: of each text of words; often: how often a slot's words occur."""

    def __init__(self, ids: np.ndarray, words: Words, n: int, often: np.ndarray):
        self.ids, self.words = ids, words
        full = np.flatnonzero(words.count)
        c = words.count[full]
        k = np.maximum(1, c - n + 1)
        start = np.repeat(words.first[full] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        length, item = np.repeat(np.minimum(n, c), k), np.repeat(full, k)
        rank = np.lexsort((words.hash, often[_slot(words.hash)])).argsort()  # rarest first
        best = np.full(len(start), np.iinfo(np.int64).max)
        off = np.zeros(len(start), dtype=np.int64)
        for o in range(int(length.max(initial=0))):
            live = np.flatnonzero(length > o)
            r = rank[start[live] + o]
            better = r < best[live]
            best[live[better]], off[live[better]] = r[better], o
        key = words.hash[start + off] if len(off) else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.start, self.length, self.item, self.off = (x[order] for x in (start, length, item, off))
        self.member = Member(key)
        self.low = np.searchsorted(key[order], self.member.values, side="left")
        self.high = np.searchsorted(key[order], self.member.values, side="right")

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Of each window that occurs: its first word's place in w, and its number."""
        at, place = self.member.where(w.hash)
        n = self.high[place] - self.low[place]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        cuts = np.unique(np.searchsorted(np.cumsum(n), np.arange(1 << 20, int(n.sum()) + (1 << 20), 1 << 20)) + 1) if len(n) else []
        i = 0
        for j in cuts:
            found.append(self._verified(w, at[i:j], place[i:j], n[i:j]))
            i = j
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _verified(self, w: Words, p: np.ndarray, q: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.repeat(self.low[q], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = np.repeat(p, n)
        doc = w.doc[p]
        p = p - self.off[k]
        ok = (p >= w.first[doc]) & (p + self.length[k] <= w.first[doc + 1])
        p, k = p[ok], k[ok]
        longest = int(self.length.max(initial=0))
        for exact in (False, True):  # hashes turn away, bytes confirm
            for o in range(longest):
                within = np.flatnonzero(self.length[k] > o)
                i, j = p[within] + o, self.start[k[within]] + o
                same = np.ones(len(p), dtype=bool)
                same[within] = same_words(w, i, self.words, j) if exact else w.hash[i] == self.words.hash[j]
                p, k = p[same], k[same]
        return p, k


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def _words(texts: list[bytes]) -> Words:
    return Words(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)]), ALNUM)


def _pieces(text: bytes, n: int) -> Iterator[bytes]:
    """The text, or runs of PIECE windows of n words if it has more; each window is in one run."""
    if len(text) <= 2 * PIECE:
        yield text
        return
    w = _words([text])
    for i in range(0, max(1, len(w.start) - n + 1), PIECE):
        last = min(i + PIECE + n - 1, len(w.start)) - 1
        yield text[w.start[i] : w.end[last]] if last >= 0 else b""


def _blocks(bench: DataFrame, id_col: str, text_col: str, n: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Ids and texts of items, or of pieces of long ones, about BLOCK_WORDS words at a time."""
    ids, texts, size = [], [], 0
    for row in bench.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null").toLocalIterator():
        for t in _pieces(row.t.encode(), n):
            ids.append(row.i)
            texts.append(t)
            size += len(t) // 2 + 1
            if size >= BLOCK_WORDS:
                yield np.array(ids, dtype=object), texts
                ids, texts, size = [], [], 0
    if ids:
        yield np.array(ids, dtype=object), texts


def _counted(wanted):
    """Counts by slot of the words of a column of texts; wanted: a broadcast of the slots to count, or None."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SLOTS, dtype=np.int64)
        keep = np.unpackbits(wanted.value).astype(bool) if wanted is not None else None
        for batch in batches:
            for _, _, w in _words_of(batch, 0):
                s = _slot(w.hash)
                n += np.bincount(s if keep is None else s[keep[s]], minlength=SLOTS)
        k = np.flatnonzero(n)
        yield pa.record_batch([pa.array(k.astype(np.int64)), pa.array(n[k])], ["s", "n"])

    return run


def _slots(texts: DataFrame, text_col: str, wanted=None) -> np.ndarray:
    """How often the words of each slot occur; at most SLOTS rows come to the driver."""
    rows = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counted(wanted), "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SLOTS, dtype=np.int64)
    out[rows["s"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def _digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def _probe(index, last: bool, keep_text: bool):
    """One pass. Rows are id, text and, after the first pass, hit (places of words) and items; the last gives the results."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = whole(index.value, Index, Member, Words)
        for batch in batches:
            for i, j, w in _words_of(batch, 1):
                at, k = ix.hits(w)
                edge = np.bincount(at, minlength=len(w.hash) + 1) - np.bincount(at + ix.length[k], minlength=len(w.hash) + 1)
                hit = np.cumsum(edge)[:-1] > 0
                items: list[set[str]] = [set() for _ in range(j - i)]
                if batch.num_columns > 2:
                    for d, (places, names) in enumerate(zip(batch.column(2).slice(i, j - i), batch.column(3).slice(i, j - i).to_pylist(), strict=True)):
                        hit[w.first[d] + places.values.to_numpy()] = True
                        items[d].update(names)
                pair = np.unique(w.doc[at] * len(ix.ids) + ix.item[k]) if len(at) else np.zeros(0, np.int64)
                for d, item in zip(*divmod(pair, max(1, len(ix.ids))), strict=True):
                    if (name := ix.ids[item]) is not None:
                        items[d].add(name)
                names = [sorted(x) for x in items]
                out = {"id": batch.column(0).take(pa.array(np.arange(i, j)))}  # a slice of a struct would be sent with all its rows
                if last:
                    out["n_words"] = pa.array(w.count.astype(np.int64))
                    out["n_hit"] = pa.array(np.bincount(w.doc[hit], minlength=j - i).astype(np.int64))
                    out["items"] = pa.array(names, pa.list_(pa.string()))
                    out["digest"] = pa.array([_digest(x) for x in names])
                    if keep_text:
                        out["text"] = batch.column(1).slice(i, j - i)
                else:
                    cuts = np.searchsorted(np.flatnonzero(hit), w.first)
                    where = np.flatnonzero(hit) - np.repeat(w.first[:-1], np.diff(cuts))
                    out |= {"text": batch.column(1).slice(i, j - i), "hit": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(where, pa.int64())), "items": pa.array(names, pa.list_(pa.string()))}
                yield pa.record_batch(list(out.values()), list(out))

    return run


def contamination(docs: DataFrame, bench: DataFrame, words: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items (sorted as strings), items_sha256, contaminated; its text if asked."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    wanted = spark.sparkContext.broadcast(np.packbits(_slots(bench, item_text_col) > 0))
    often = _slots(rows, "text", wanted)
    blocks = itertools.chain(_blocks(bench, item_col, item_text_col, words), [None])
    block = next(blocks) or (np.zeros(0, object), [])
    while block is not None:
        after = next(blocks, None)
        index = spark.sparkContext.broadcast(plain(Index(block[0], _words(block[1]), words, often)))
        if after is not None:
            rows = stash(rows.mapInArrow(_probe(index, False, True), f"id {kind}, text string, hit array<bigint>, items array<string>"), "hits")
        else:
            rows = rows.mapInArrow(_probe(index, True, keep_text), f"id {kind}, n_words long, n_hit long, items array<string>, digest string" + ", text string" * keep_text)
        block = after
    text = ["text"] if keep_text else []
    return rows.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", F.col("digest").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), *text)


ORACLE = r"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest([w[i : i + least(10, len(w)) - 1] for i in range(1, greatest(1, len(w) - 9) + 1)]) AS g FROM iw WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM g),
dp AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM dw, ns WHERE len(w) >= n),
h AS (SELECT dp.rid, dp.p, dp.n, g.item_id FROM dp JOIN g ON dp.n = g.n AND dp.w[dp.p : dp.p + dp.n - 1] = g.g),
hp AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hp USING (rid) LEFT JOIN hi USING (rid)
"""
