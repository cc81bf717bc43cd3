"""Readers of JSON-lines records. Schemas are explicit; each reader says what it does with bad lines.

Order is kept as (source_path, line_no): line numbers are physical, from 1, and blank lines count. With folders, the files of a
folder, in order of their names, are one shard: source_path is the folder, and its lines are numbered from one file to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import text as X

MESSAGES = "array<struct<role string, content string>>"
#: Superset of the nested failure form and the instruction form.
FAILURE = (
    "id string, failure_class string, vertical string, source_model string, context struct<user_prompt string, model_output string, system_prompt string>, failure_details struct<errors array<string>>, "
    "source string, specialty string, instruction string, reasoning string, output string, mechanism string, fingerprint string, score double, lineage struct<gen_model string>"
)
TRACE = f"messages {MESSAGES}, metadata struct<vertical string>"
CONVERSATION = f"messages {MESSAGES}"
CELL = "cell_id string, fingerprint string, domain string, task_type string, verification_score int, grade string, source_pair_id string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def require(spark: SparkSession, *paths: str) -> None:
    """FileNotFoundError for the first path that isn't there."""
    for p in paths:
        if not _exists(spark, p):
            raise FileNotFoundError(p)


def discover(spark: SparkSession, path: str, pattern: str = "shard_*.jsonl", recursive: bool = True) -> DataFrame:
    """(path, sha256, bytes) of files by name pattern; empty if the folder is missing."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "path string, sha256 string, bytes long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    files = files.option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def path_order(files: DataFrame) -> DataFrame:
    """files with file_ord from 0, by path components rather than as plain text."""
    return files.withColumn("file_ord", F.dense_rank().over(Window.orderBy(F.split("path", "/"))) - 1)


def _shard(path: str, folders: bool) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "") if folders else F.col(path)


def numbered_lines(spark: SparkSession, path: str | list[str], folders: bool = False) -> DataFrame:
    """(source_path, line_no, line). Files are read by splits, however long they are.

    Lines are numbered within each split, and the splits' line counts, one row for each split, are summed up by shard: a first
    pass counts, and each use of the result is a second. A line ends with LF, CR or CR LF.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("m"))
    counts = rows.groupBy("source_path", "block").agg(F.min("m").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(_shard("source_path", folders)).orderBy("source_path", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = counts.select("source_path", "block", (before - F.col("first") + 1).alias("shift"))
    # the driver holds a record of each split as it is; the size being known, small ones are broadcast and large ones shuffled
    starts = spark.createDataFrame(found.collect(), found.schema)
    return rows.join(starts, ["source_path", "block"]).select(_shard("source_path", folders).alias("source_path"), (F.col("m") + F.col("shift")).alias("line_no"), "line")


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """lines with value (null for bad lines), is_blank and is_bad. A line that is JSON but not an object is bad."""
    text = X.strip(F.col("line"))
    value = F.from_json(text, T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))
    return lines.withColumns({"is_blank": text == "", "is_bad": (text != "") & ~is_object, "value": F.when(is_object, value)})


def read_lenient(spark: SparkSession, path: str | list[str], schema: str, folders: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine): blank lines are skipped, malformed ones go to quarantine with their place."""
    p = parsed(numbered_lines(spark, path, folders), schema)
    return p.where("not is_blank and not is_bad").select("value.*", "source_path", "line_no"), p.where("is_bad").select("source_path", "line_no", "line")


def read_skipping(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Records without line numbers, malformed lines dropped: splittable, for large files where order doesn't matter."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_strict(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Any malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Strict, and each row must have at least two messages."""
    rows = read_strict(spark, path, CONVERSATION)
    bad = F.coalesce(F.size("messages"), F.lit(0)) < 2
    return rows.withColumn("messages", F.when(bad, F.raise_error(F.lit("fewer than two messages")).cast(MESSAGES)).otherwise(F.col("messages")))


def read_for_audit(spark: SparkSession, path: str | list[str], folders: bool = False) -> DataFrame:
    """(source_path, line_no, form, messages) of each record; form tells absent, not a list and list apart. Bad lines: form bad."""
    p = parsed(numbered_lines(spark, path, folders), CONVERSATION).where("not is_blank")
    v = F.try_variant_get(F.try_parse_json("line"), "$.messages", "variant")
    kind = F.schema_of_variant(v)
    form = F.when(F.col("is_bad"), "bad").when(v.isNull(), "absent").when(kind.startswith("ARRAY"), "list").otherwise("not a list")
    return p.select("source_path", "line_no", form.alias("form"), F.col("value.messages").alias("messages"))


def line_counts(spark: SparkSession, path: str | list[str], folders: bool = False) -> DataFrame:
    """(source_path, lines): lines that are not blank, counted without parsing."""
    files = spark.read.text(path).where(X.strip(F.col("value")) != "").select(F.col("_metadata.file_path").alias("source_path"))
    return files.groupBy(_shard("source_path", folders).alias("source_path")).agg(F.count("*").alias("lines"))
