"""Language identification with language-bitmask n-gram filters.

Learning: the n-grams (4 bytes of lower-cased letters, every run of other bytes being one space) of labelled documents are
counted for each language. A language contains an n-gram if it makes up at least LEAST of the language's n-grams and at least
SHARE of the share it has in the language where it is most common; so stray foreign passages don't count. The sets go into
one bit-sliced Bloom filter: a slot holds a bit for each language, an n-gram sets its languages' bits in HASHES slots, and
the bitwise AND of its slots returns all languages that contain it.

Prediction: each n-gram of a text is looked up; per-language popcounts are corrected for false positives: a language whose
slice is filled to f answers to a foreign n-gram with probability f^HASHES, so the count expected of the true members is
(count - n * fp) / (1 - fp). The largest decides (ties: the first language in order). score: its share of the text's n-grams.

Scale: about SAMPLE different labelled texts of each language are learned from (the documented bound; they are chosen by a
hash of the text, and equal texts count once). Counts are summed before the shuffle. The filter is combined by bitwise OR in the cluster, and what is
broadcast has a fixed size: SLOTS words for each 32 languages; all labels are learned. Texts are read whole, in one pass, without a shuffle.

Nulls and edge cases: null texts and those without letters are `und` with score 0. Texts none of whose n-grams are known get the
language with most documents, score 0. Without labelled documents every text is `und`. A null id is held out. Repeated rows are
learned from once and predicted each; ties go to the first language in order. Very long texts are read whole. An empty table
gives an empty result. Only id, text and language are read, the language for learning alone; carried columns named lang_pred,
score or text are replaced by ours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import _LOWER, chunks, mix, plain, trimmed, utf8, whole
from loomset.scratch import stash

SAMPLE, LEAST, SHARE = 4000, 2e-6, 0.2
SLOTS, HASHES, N = 1 << 20, 3, 4

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32(id as text) mod 5 = remainder; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(True))


def grams(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of each document of a run, as integers, and where each document's begin."""
    n = len(offs) - 1
    # a space around each document keeps n-grams within it
    at = np.arange(len(b)) + np.repeat(np.arange(n), np.diff(offs)) + 1
    x = np.full(len(b) + n + 1, 32, dtype=np.uint8)
    low = _LOWER[b]
    x[at] = np.where(_LETTER[low], low, 32)
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    border = offs + np.arange(n + 1)
    x, place = x[keep], np.cumsum(keep) - 1
    g = np.zeros(max(0, len(x) - N + 1), dtype=np.uint64)
    for k in range(N):
        g = g << np.uint64(8) | x[k : k + len(g)]
    starts = np.minimum(place[border], len(g))
    # n-grams that reach over a document's end belong to none
    ok = np.ones(len(g), dtype=bool)
    for d in place[border[1:]]:
        ok[max(0, d - N + 2) : d] = False
    return g[ok], np.concatenate([[0], np.cumsum(ok)])[starts]


@trimmed
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = batch.column(0).to_pylist()
        for name in sorted(set(lang)):
            part = batch.filter(pa.array([x == name for x in lang]))
            b, offs = utf8(part.column(1))
            for i, j in chunks(offs):
                g, _ = grams(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                g, n = np.unique(g, return_counts=True)
                yield pa.record_batch([pa.array([name] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def slots_of(g: np.ndarray) -> list[np.ndarray]:
    h = mix(g.astype(np.uint64) + np.uint64(0x1234567))
    return [(h >> np.uint64(20 * k) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


@trimmed
def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        g, word, bit = (batch.column(k).to_numpy() for k in range(3))
        s = np.concatenate(slots_of(g.view(np.uint64)))
        yield pa.record_batch([pa.array(s), pa.array(np.tile(word, HASHES)), pa.array(np.tile(bit, HASHES))], ["slot", "word", "bit"])


class Filter:
    def __init__(self, langs: list[str], table: np.ndarray, usual: str):
        self.langs, self.table, self.usual = langs, table, usual
        fill = np.array([(table[k // 32] >> np.uint32(k % 32) & 1).mean() for k in range(len(langs))])
        self.fp = fill**HASHES

    def predict(self, g: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each document's language (-1: no n-gram is known) and its score."""
        n = np.diff(starts)
        s = slots_of(g)
        count = np.zeros((len(n), len(self.langs)))
        for w in range(len(self.table)):
            m = self.table[w][s[0]]
            for x in s[1:]:
                m &= self.table[w][x]
            for k in range(32 * w, min(32 * w + 32, len(self.langs))):
                run = np.concatenate([[0], np.cumsum(m >> np.uint32(k % 32) & 1, dtype=np.int64)])
                count[:, k] = run[starts[1:]] - run[starts[:-1]]
        real = np.maximum(0, (count - n[:, None] * self.fp) / (1 - np.minimum(self.fp, 0.999)))
        best = real.argmax(1)
        share = real[np.arange(len(n)), best] / np.maximum(n, 1)
        return np.where(share > 0, best, -1), np.minimum(share, 1.0)


def learn(docs: DataFrame, text_col: str, lang_col: str) -> Filter | None:
    """Learns from all rows with a language; docs: the training rows."""
    spark = docs.sparkSession
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    hashed = rows.select("lang", F.xxhash64("text").alias("h"))
    kinds = hashed.groupBy("lang", "h").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum("n").alias("documents"), F.count("*").alias("kinds"))
    known = kinds.orderBy(F.col("documents").desc(), "lang").collect()  # a row for each language
    if not known:
        return None
    usual, names = known[0][0], sorted(r[0] for r in known)
    sizes = spark.createDataFrame([(r[0], r[2]) for r in known], "l string, kinds long")
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    rows = rows.join(F.broadcast(sizes), F.col("lang") == F.col("l")).where(part < SAMPLE / F.col("kinds")).select("lang", "text").distinct()
    n = stash(rows.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    total = spark.createDataFrame(n.groupBy("lang").agg(F.sum("n")).collect(), "l string, total long")
    share = n.join(F.broadcast(total), F.col("lang") == F.col("l")).select("lang", "gram", (F.col("n") / F.col("total")).alias("p"))
    share = share.withColumn("top", F.max("p").over(Window.partitionBy("gram"))).where((F.col("p") >= LEAST) & (F.col("p") >= SHARE * F.col("top")))
    number = spark.createDataFrame([(x, i // 32, 1 << i % 32) for i, x in enumerate(names)], "l string, word int, bit long")
    bits = share.join(F.broadcast(number), F.col("lang") == F.col("l")).groupBy("gram", "word").agg(F.bit_or("bit").alias("bit"))
    slots = stash(bits.mapInArrow(_slots, "slot long, word int, bit long").groupBy("slot", "word").agg(F.bit_or("bit").alias("bit")), "language-slots")
    table = np.zeros(((len(names) + 31) // 32, SLOTS), dtype=np.uint32)
    for w in range(len(table)):  # word by word, to bound what is gathered at once
        p = slots.where(F.col("word") == w).select("slot", "bit").toPandas()
        table[w][p["slot"].to_numpy(np.int64)] = p["bit"].to_numpy(np.int64).astype(np.uint32)
    return Filter(names, table, usual)


def _has_letters(text: bytes) -> bool:
    x = np.frombuffer(text, dtype=np.uint8)
    return bool(((x | 32 >= 97) & (x | 32 <= 122) & (x < 128)).any()) or (bool((x >= 128).any()) and any(c.isalpha() for c in text.decode(errors="ignore")))


def _predict(shared, keep_text: bool):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = whole(shared.value, Filter)
        for batch in batches:
            b, offs = utf8(batch.column(batch.num_columns - 1))
            for i, j in chunks(offs):
                part, o = b[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                letters = [_has_letters(part[o[d] : o[d + 1]].tobytes()) for d in range(j - i)]
                if f is None:
                    name, score = ["und"] * (j - i), [0.0] * (j - i)
                else:
                    best, share = f.predict(*grams(part, o))
                    name = ["und" if not ok else f.usual if k < 0 else f.langs[k] for ok, k in zip(letters, best, strict=True)]
                    score = np.where(letters, share, 0.0)
                x = batch.column(0).take(pa.array(np.arange(i, j)))  # a slice of a struct would be sent with all its rows
                cols = [x, pa.array(name, pa.string()), pa.array(score, pa.float64())]
                if keep_text:
                    cols.append(batch.column(1).slice(i, j - i))
                yield pa.record_batch(cols, ["x", "lang_pred", "score", "text"][: len(cols)])

    return run


def identify(docs: DataFrame, model: Filter | None, carry: list[str], text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs' columns carry, lang_pred, score, and text if asked."""
    carry = [c for c in carry if c not in ("lang_pred", "score", "text")]
    shared = docs.sparkSession.sparkContext.broadcast(plain(model))
    rows = docs.select(F.struct(*carry).alias("x"), F.col(text_col).cast("string").alias("_text"))
    out = rows.mapInArrow(_predict(shared, keep_text), f"x {rows.schema['x'].dataType.simpleString()}, lang_pred string, score double" + ", text string" * keep_text)
    return out.select("x.*", "lang_pred", "score", *["text"] * keep_text)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, held_out (crc32 of the id mod 5 = 0: not learned from), lang_pred, score."""
    out = held_out(F.col(id_col), 0)
    model = learn(docs.where(~out), text_col, lang_col)
    return identify(docs, model, [id_col], text_col).select(id_col, held_out(F.col(id_col), 0).alias("held_out"), "lang_pred", "score")
