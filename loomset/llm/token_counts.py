"""Token counts of documents by a separator scan over flat unindexed token files.

A token file is a bare sequence of 16-bit little-endian identifiers, nothing else. Identifier 0 ends a document; a
vocabulary's identifiers are shifted by one (so vocabularies of up to 65,535 entries). A document is HEADER identifiers that
spell its id, its tokens, and the end. No document crosses files, but there is no index of where one begins.

Writing. Documents are tokenised with a public vocabulary (read on the driver and broadcast: its size is fixed) and written
by Spark's own text writer: a row holds the identifiers of documents with ends between them, about RUN bytes or one longer
document, and the line end is the last one's end. A file holds at most FILE_RUNS rows.

Scanning. Files are read as bytes and cut into blocks of BLOCK identifiers, without regard to documents. In each block one
vectorised comparison finds all ends. Documents that lie within a block are counted at once. The first and last piece of
each block may be part of a longer document: a prefix scan over the pieces of a file, in order, numbers the ends before
each, and the pieces between two ends add up to a document; its header may be spread over pieces likewise.

Scale: one pass writes and one reads, without a shuffle but for at most two pieces for each block. A file, which one task reads
whole, has at most about 64 MB, or FILE_RUNS documents that are longer than a run.

Nulls and edge cases: null and empty texts have 0 tokens. Null and repeated ids are told from the header as they are. A file that
lacks its last end still gives its last document; what is too short for a header (a torn file) is a row of nulls. Empty tables
give an empty result. Very long texts are tokenised whole; where the tokeniser's pattern engine gives up (white space by the
megabyte), the same pattern is applied by another. Only id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.scratch import new_path

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the vocabulary's texts are split, fixed with it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = "\x00\x00"
HEADER, BLOCK, RUN, FILE_RUNS = 6, 1 << 20, 8 << 20, 8


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        except ValueError:
            import regex

            return np.array([t for piece in regex.findall(PATTERN, text) for t in self.encoding._encode_single_piece(piece)], dtype=np.uint32)


def header(doc_id: int | None) -> list[int]:
    """Six identifiers other than 0: whether there is an id, and five times 13 bits of it."""
    if doc_id is None:
        return [1] * HEADER
    x = doc_id & (1 << 64) - 1
    return [2, *(1 + (x >> 13 * k & 0x1FFF) for k in range(HEADER - 1))]


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer(shared.value)
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            return pa.record_batch([pa.array([END.encode().join(held)], pa.binary())], ["value"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = t.encode(text.as_py() or "") + 1
                document = np.concatenate([header(doc_id), ids]).astype("<u2").tobytes()
                if held and size + len(document) > RUN:
                    yield flushed()
                    held, size = [], 0
                held.append(document)
                size += len(document) + len(END)
        if held:
            yield flushed()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> None:
    shared = docs.sparkSession.sparkContext.broadcast(ranks_of(vocabulary))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(_encode(shared), "value binary").select(F.col("value").cast("string")).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RUNS).text(path)


PIECE = "path string, block int, piece int, n long, head array<int>, closed boolean, whole boolean"


def pieces(tokens: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: start and length of each piece between ends (the last is open), by one comparison."""
    for at in range(0, len(tokens), block):
        part = tokens[at : at + block]
        ends = np.flatnonzero(part == 0)
        start = np.concatenate([[0], ends + 1])
        yield at + start, np.concatenate([ends, [len(part)]]) - start, ends


def _scan(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                tokens = np.frombuffer(content.as_buffer(), dtype="<u2")
                for b, (start, n, ends) in enumerate(pieces(tokens, block)):
                    k = len(n)
                    closed = np.arange(k) < len(ends)
                    whole = closed & ((np.arange(k) > 0) | (b == 0))
                    take = np.minimum(n, HEADER)
                    flat = np.repeat(start - (np.cumsum(take) - take), take) + np.arange(take.sum())
                    head = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32()), pa.array(tokens[flat].astype(np.int32)))
                    yield pa.record_batch([pa.array([path.as_py()] * k), pa.array(np.full(k, b, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(n), head, pa.array(closed), pa.array(whole)], [x.split()[0] for x in PIECE.split(", ")])

    return run


def scan_tokens(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """One row per document of the token files under path: doc_id (null if it has none), n_tokens."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    rows = files.mapInArrow(_scan(block), PIECE)
    whole = rows.where("whole").select("n", "head")
    order = Window.partitionBy("path").orderBy("block", "piece")
    part = rows.where("not whole").withColumn("document", F.coalesce(F.sum(F.col("closed").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    heads = F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("block", "piece", "head"))))
    joined = part.groupBy("path", "document").agg(F.sum("n").alias("n"), F.flatten(F.transform(heads, lambda x: x["head"])).alias("head")).select("n", F.slice("head", 1, HEADER).alias("head"))
    digits = [(F.get("head", F.lit(k + 1)).cast("long") - 1) for k in range(HEADER - 1)]
    doc_id = digits[0]
    for k, d in enumerate(digits[1:], 1):
        doc_id = doc_id.bitwiseOR(F.shiftleft(d, 13 * k))
    both = whole.union(joined).where("n > 0")
    told = F.col("n") >= HEADER
    return both.select(F.when(told & (F.get("head", F.lit(0)) == 2), doc_id).alias("doc_id"), F.when(told, F.col("n") - HEADER).alias("n_tokens"))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs as token files in the shared folder and scans these: doc_id, n_tokens."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, id_col, text_col)
    return scan_tokens(docs.sparkSession, path, block)
