"""Removal of byte strings that occur more than once, by suffix arrays built with two-stage sorting.

A byte is removed if a string of `length` bytes that covers it also starts anywhere else, in the same document or another.

Suffix array (suffix_array): a suffix that is smaller than its successor (the suffix one byte later) is sorted directly;
all others are induced by one scan over the buckets of first bytes, each placing its predecessor at the front of that byte's
bucket. The scan goes bucket by bucket, and within a bucket by runs of equal bytes, so each step is vectorised. Adjacent
common prefixes of `length` bytes or more, compared byte by byte (common_prefixes), mark what repeats.

Distribution. Suffixes that share `length` bytes must meet. Each string of that length has an anchor, the leftmost smallest
hash among its GRAM-byte substrings; equal strings have equal anchors at equal places. The consecutive starts of a document
with one anchor form a fragment, which is their strings' text, on average three times as long as the starts are many.

1. Anchors are counted; a fragment whose anchor occurs once holds no repeat and goes no further.
2. Equal fragments fold into one with its count (summed before the shuffle): in the suffix array the suffixes of copies
   stand side by side, so one entry stands for them all, and a count above one is a common prefix of full length. A
   fragment that is alone with its anchor needs no sorting: its copies are its only neighbours.
3. Anchors with more than GROUP different fragments (a passage that many documents share, in different surroundings) are
   split by content: starts are halved by their distance to the anchor, and each half goes by the hash of the text that all
   its strings share. Equal strings stay together; parts that are alone drop out. This ends at single starts.
4. Groups are packed into suffix arrays of about BATCH bytes. Found starts go back to the documents by equi-joins.

Nothing is capped, and no task holds more than a batch, a document, or a group of GROUP fragments.

Hashes: what differs is told apart on bytes, within a suffix array. What is folded as a copy (step 2) is not compared on bytes:
it has the same 64-bit hash of its anchor, of its text and of its length, which makes two different fragments of a corpus of
10^12 alike with a probability below 10^-12 (fragments are shorter than 2 * `length` bytes; inputs that such a hash is known
to confuse have 1,024 bytes or more).

Nulls and edge cases: null text is empty; texts shorter than `length` are kept whole. Rows equal in id and text are two
documents, hence each other's repeat; their fragments are cut out once. Ids may be null or repeated. Very long texts are read
whole. An empty table gives an empty result. Only id and text are read; carried columns that have the name of one of ours are
replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import _powers, chunks, mix, trimmed, utf8, whole_groups
from loomset.scratch import stash

GRAM, GROUP, BATCH = 73, 2048, 1 << 19


class Hasher:
    """Hash of each substring of a byte array, from one running sum."""

    def __init__(self, b: np.ndarray):
        self.p, self.q = _powers(len(b) + 1)
        self.run = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.p[: len(b)], out=self.run[1:])

    def all(self, size: int) -> np.ndarray:
        n = len(self.run) - size
        return mix((self.run[size:] - self.run[:n]) * self.q[:n]) if n > 0 else np.zeros(0, np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.run[end] - self.run[start]) * self.q[start] + (end - start).astype(np.uint64))


def fragments(b: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of all fragments of a run of documents: document, first start (in b), starts, the first's distance to the anchor,
    the anchor's hash, the fragment's hash."""
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if len(b) < length:
        return none
    h, size = Hasher(b), min(GRAM, (length + 1) // 2)
    gram = h.all(size)
    shift = np.uint64(max(20, int(len(b)).bit_length()))
    key = (gram >> shift << shift) | np.arange(len(gram), dtype=np.uint64)
    width, w = length - size + 1, 1
    low = key
    while 2 * w <= width:
        low = np.minimum(low[:-w], low[w:])
        w *= 2
    if w < width:
        low = np.minimum(low[: len(low) - (width - w)], low[width - w :])
    anchor = (low & np.uint64((1 << int(shift)) - 1)).astype(np.int64)  # of each start
    size = np.diff(offs)
    ok = np.zeros(len(anchor) + 1, dtype=np.int8)
    long = size >= length
    np.add.at(ok, offs[:-1][long], 1)
    np.add.at(ok, offs[1:][long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(ok[:-1]))
    if not len(start):
        return none
    a = anchor[start]
    cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)]))
    first, n = start[cut], np.diff(np.concatenate([cut, [len(start)]]))
    doc = np.searchsorted(offs, first, side="right") - 1
    return doc, first, n, a[cut] - first, gram[a[cut]], h.of(first, first + n + length - 1)


FRAGMENT = "key long, anchor long, frag long, first int, n int, off int"


def _fragments(length: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            b, offs = utf8(batch.column(1))
            for i, j in chunks(offs):
                part, o = b[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                doc, first, n, off, anchor, frag = fragments(part, o, length)
                cols = [key[i + doc], anchor.view(np.int64), frag.view(np.int64), (first - o[doc]).astype(np.int32), n.astype(np.int32), off.astype(np.int32)]
                yield pa.record_batch([pa.array(x) for x in cols], ["key", "anchor", "frag", "first", "n", "off"])

    return run


def suffix_array(b: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of b, in order of their first `depth` bytes or more, by two-stage sorting."""
    n = len(b)
    if not n:
        return np.zeros(0, np.int64)
    nxt = np.zeros(n, dtype=np.int16)
    nxt[:-1] = b[1:]
    nxt[-1] = -1
    differs = b != nxt
    # what the next unequal byte says holds for a run of equal ones
    at = np.where(differs, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    smaller = b.astype(np.int16)[at] < nxt[at]  # than its successor: sorted directly
    direct = _direct(b, np.flatnonzero(smaller), depth)
    first = b[direct]
    cuts = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[b[n - 1]].append(np.array([n - 1]))  # induced by the empty suffix, the smallest
    out = []
    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(b[before] == c) & ~smaller[before]]
        bucket.append(direct[cuts[c] : cuts[c + 1]])
        all_c = np.concatenate(bucket)
        out.append(all_c)
        before = all_c[all_c > 0] - 1
        before = before[(b[before] > c) & ~smaller[before]]
        if len(before):
            byte = b[before]
            order = np.argsort(byte, kind="stable")
            before, byte = before[order], byte[order]
            edge = np.flatnonzero(np.diff(byte)) + 1
            for part in np.split(before, edge):
                waiting[b[part[0]]].append(part)
    return np.concatenate(out)


def _direct(b: np.ndarray, pos: np.ndarray, depth: int) -> np.ndarray:
    """pos, sorted by the suffixes there, eight bytes at a time; a group that is equal over depth bytes needs no more."""
    if not len(pos):
        return pos
    pad = np.zeros(len(b) + depth + 16, dtype=np.uint8)
    pad[: len(b)] = b
    word = np.zeros(len(b) + depth + 8, dtype=np.uint64)
    for k in range(8):
        word |= pad[k : k + len(word)].astype(np.uint64) << np.uint64(56 - 8 * k)
    same = Hasher(pad[: len(b) + depth]).all(depth)
    order = np.argsort(word[pos])
    pos = pos[order]
    w = word[pos]
    # live: places in pos of groups that are equal so far but not over depth bytes; g: their groups
    live, g, at = np.arange(len(pos)), np.cumsum(np.concatenate([[0], w[1:] != w[:-1]])), 8
    while at < depth:
        head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        size = np.diff(np.concatenate([head, [len(g)]]))
        h = same[pos[live]]
        unequal = np.logical_or.reduceat(h != np.repeat(h[head], size), head)
        keep = np.repeat(unequal, size)
        live, g = live[keep], g[keep]
        if not len(live):
            break
        p = pos[live]
        w = word[p + at]
        order = np.lexsort((w, g))
        pos[live] = p[order]
        w, g = w[order], g[order]
        g = np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]) | (w[1:] != w[:-1])]))
        at += 8
    return pos


def common_prefixes(b: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Marks each start in order whose suffix shares `length` bytes with a neighbour's. Every start has that many left."""
    hit = np.zeros(len(b), dtype=bool)
    h = Hasher(b).all(length)
    k = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(k):
        return hit
    low, high = np.minimum(order[k], order[k + 1]), np.maximum(order[k], order[k + 1])
    far = high - low
    by = np.lexsort((low, far))
    low, far = low[by], far[by]
    cut = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1] + 1) | (far[1:] != far[:-1])]))
    n = np.diff(np.concatenate([cut, [len(low)]]))
    # runs of pairs at one distance: compare each run's text once
    size = n + length - 1
    base = np.cumsum(size) - size
    idx = np.repeat(low[cut] - base, size) + np.arange(size.sum())
    differs = np.concatenate([[0], np.cumsum(b[idx] != b[idx + np.repeat(far[cut], size)])])
    s = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(len(low))
    ok = differs[s + length] == differs[s]
    hit[low[ok]] = True
    hit[low[ok] + far[ok]] = True
    return hit


def repeats(b: np.ndarray, offs: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of starts whose strings occur elsewhere in the texts: the text of each border of a run, and its place there.

    Borders alternate between the first start of a run and the start after its last. A text's copies are entries of the suffix
    array that stand next to its own and equal it, so they are counted, not repeated: all starts of such a text are hits.
    """
    n, size = len(offs) - 1, np.diff(offs)
    where = offs[:-1] + np.arange(n)
    x = np.full(len(b) + n, 0xFF, dtype=np.uint8)
    x[np.arange(len(b)) + np.repeat(np.arange(n), size)] = b
    valid = np.repeat(where + size, size + 1) - np.arange(len(x)) >= length
    order = suffix_array(x, length)
    hit = common_prefixes(x, order[valid[order]], length) | (np.repeat(count > 1, size + 1) & valid)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    text = np.searchsorted(where, edge, side="right") - 1
    return text, edge - where[text]


HITS = "anchor long, frag long, hits array<int>"


def _search(length: int):
    def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor, core, frag, c, lo = (t[k].to_numpy() for k in ("anchor", "core", "frag", "c", "lo"))
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (core[1:] != core[:-1])]))
        size = np.diff(np.concatenate([first, [len(anchor)]]))
        # a text that is alone in its group has only its copies for neighbours
        alone = np.repeat(size == 1, size)
        k = np.flatnonzero(alone)
        n = pa.compute.binary_length(t["text"]).to_numpy()[k] - length + 1
        yield _hits(anchor[k], frag[k], 2 * np.arange(len(k) + 1), np.stack([lo[k], lo[k] + n], 1).ravel())
        k = np.flatnonzero(~alone)
        b, offs = utf8(t["text"].take(pa.array(k)))
        text, at = repeats(b, offs, c[k], length)
        rows, first = np.unique(text, return_index=True)
        yield _hits(anchor[k][rows], frag[k][rows], np.concatenate([first, [len(text)]]), at + lo[k][text])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["anchor", "core"], "text", BATCH):
            yield from found(t)

    return run


def _hits(anchor: np.ndarray, frag: np.ndarray, offs: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    hits = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(at, pa.int32()))
    return pa.record_batch([pa.array(anchor), pa.array(frag), hits], ["anchor", "frag", "hits"])


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            yield batch.slice(i, size)


def _cut(length: int):
    """Texts of the listed fragments of each document."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in _slices(batches, 1000):
            out = []
            for row in batch.to_pylist():
                if row["key"] == last:  # rows equal in id and text stand together
                    continue
                last, t = row["key"], row["text"]
                out += [(f["anchor"], f["frag"], f["c"], f["off"], t[f["first"] : f["first"] + f["n"] + length - 1]) for f in row["list"]]
                if len(out) > 20_000:
                    yield _cut_batch(out)
                    out = []
            if out:
                yield _cut_batch(out)

    return run


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["anchor", "frag", "c", "off", "text"])


PART = "anchor long, core long, frag long, c long, lo int, off int, step int, text binary"
_PART = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _halve(length: int):
    """Splits each row's starts into blocks of half as many distances to the anchor.

    core: hash of the block's place and of the text that all its strings share, so that equal strings stay together.
    """

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 4000):
            out = []
            for r in batch.to_pylist():
                n, near, step, i = len(r["text"]) - length + 1, r["off"] - r["lo"], r["step"] // 2, 0
                while i < n:
                    low = (near - i) // step * step
                    j = min(n, near - low + 1)
                    shared = r["text"][near - low : near - low - step + 1 + length]
                    core = int.from_bytes(hashlib.blake2b(b"%d,%d:" % (step, low) + shared, digest_size=8).digest(), "little", signed=True)
                    out.append((r["anchor"], core, r["frag"], r["c"], r["lo"] + i, r["off"], step, r["text"][i : j + length - 1]))
                    i = j
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PART, strict=True)], [x.split()[0] for x in PART.split(", ")])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col), text).alias("key"), F.col(id_col).alias("id"), text.alias("text"))


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, spans): for documents with repeats, the byte ranges to remove as [start, end, start, end, ...], maximal and in order.

    key: xxhash64(id, text), text being empty for null.
    """
    docs = _keyed(docs, id_col, text_col)
    every = docs.select("key", "text").where(F.octet_length("text") >= length).mapInArrow(_fragments(length), FRAGMENT)
    # written first, so that both sides of the join are plain shuffles, of which a hot anchor's can be split
    often = stash(every.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor"), "anchors")
    live = stash(every.join(often, "anchor"), "fragments")
    kinds = live.groupBy("anchor", "frag").agg(F.count("*").alias("c"), F.min(F.struct("key", "first", "n", "off")).alias("r"))
    wanted = kinds.groupBy("r.key").agg(F.collect_list(F.struct("anchor", "frag", "c", F.col("r.first").alias("first"), F.col("r.n").alias("n"), F.col("r.off").alias("off"))).alias("list"))
    texts = docs.select("key", F.col("text").cast("binary").alias("text")).join(wanted, "key").mapInArrow(_cut(length), "anchor long, frag long, c long, off int, text binary")
    step = 1 << (length - min(GRAM, (length + 1) // 2)).bit_length()  # above the largest distance to an anchor
    parts = stash(texts.selectExpr("anchor", "0L core", "frag", "c", "0 lo", "off", f"{step} step", "text"), "parts")
    hits = None
    while True:
        size = parts.groupBy("anchor", "core").agg(F.count("*").alias("k"), F.sum("c").alias("all")).where("all > 1")  # so alone means copied
        sized = parts.join(size, ["anchor", "core"])
        found = sized.where(f"k <= {GROUP}").select("anchor", "core", "frag", "c", "lo", "text").repartition("anchor", "core").sortWithinPartitions("anchor", "core").mapInArrow(_search(length), HITS)
        large = stash(sized.where(f"k > {GROUP}").select(*parts.columns), "large")
        hits = found if hits is None else hits.union(found)
        if large.isEmpty():
            break
        # a block of one distance holds one string, that all its rows share
        hits = hits.union(large.where("step = 1").select("anchor", "frag", F.expr("array(lo, lo + 1)").alias("hits")))
        parts = stash(large.where("step > 1").mapInArrow(_halve(length), PART), "parts")
    hits = stash(hits, "hits")
    ranges = live.join(hits, ["anchor", "frag"]).select("key", F.transform("hits", lambda x, i: x + F.col("first") + F.when(i % 2 == 1, F.lit(length - 1)).otherwise(F.lit(0))).alias("at")).distinct()
    return ranges.groupBy("key").agg(F.flatten(F.collect_list("at")).alias("spans")).select("key", "spans")


def merged(spans: list[int] | None) -> list[tuple[int, int]]:
    """Maximal ranges that [start, end, start, end, ...] cover."""
    out: list[list[int]] = []
    for a, z in sorted(zip(spans[::2], spans[1::2], strict=True)) if spans else ():
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            out.append([a, z])
    return [tuple(x) for x in out]


@trimmed
def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, 1000):
        rows = []
        for t, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            cuts = merged(spans)
            at, keep = 0, []
            for a, z in cuts:
                keep.append(t[at:a])
                at = z
            keep.append(t[at:])
            rows.append((len(t), sum(z - a for a, z in cuts), [{"start": a, "end": z} for a, z in cuts], b"".join(keep), "".join(k.decode(errors="ignore") for k in keep)))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        cols = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), span, pa.binary(), pa.string()), strict=True))], ["id", "n_bytes", "n_removed", "spans", "kept", "text"])


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: carry (the id by default), n_bytes, n_removed, spans (array of start, end), kept (binary: the
    bytes that remain), text (the same without characters that are cut in part)."""
    carry = [c for c in carry or [id_col] if c not in ("n_bytes", "n_removed", "spans", "kept", "text")]
    spans = repeated_spans(docs, length, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*carry).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("key"))
    rows = rows.join(spans, "key", "left").select("id", "text", "spans")
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_kept, f"id {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary, text string")
    return out.select("id.*", "n_bytes", "n_removed", "spans", "kept", "text")


#: Strings are told apart by MD5. A text is cut in pieces of 257 starts first, as SQL would look for a place in it from its beginning.
ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT r, b, substr(h, 2 * b + 1, 2 * 456) AS part FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199, 257)) AS b FROM d WHERE len(h) >= 400)),
k AS MATERIALIZED (SELECT r, b + unnest(range(1, len(part) // 2 - 198)) AS i, unnest([md5_number(substr(part, 2 * i - 1, 400)) FOR i IN range(1, len(part) // 2 - 198)]) AS g FROM w),
m AS (SELECT g FROM k GROUP BY g HAVING count(*) > 1),
s AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM k WHERE g IN (FROM m)),
n AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS p FROM s),
p AS (SELECT r, p, min(i) AS a, max(i) + 200 AS z FROM n GROUP BY r, p),
t AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS after FROM p),
x AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last FROM t GROUP BY r),
y AS (SELECT t.r, string_agg(substr(h, 2 * after - 1, 2 * (a - after)), '' ORDER BY a) AS kept FROM t JOIN d USING (r) GROUP BY t.r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(CASE WHEN x.r IS NULL THEN h ELSE y.kept || substr(h, 2 * last - 1) END)) AS kept_sha256
FROM d LEFT JOIN x USING (r) LEFT JOIN y USING (r)
"""
