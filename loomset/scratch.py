"""Intermediate tables and files in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[list[str] | None] = ContextVar("loomset_scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder if all runs on one machine, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(-cluster)?(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        local = tempfile.mkdtemp(prefix="loomset-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        found = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing has yet; it is deleted at the end of the `scratch` block that it is asked for in."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (mine := _scope.get()) is not None:
        mine.append(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete what lies under a path that nothing reads any more."""
    if (mine := _scope.get()) is not None and path in mine:
        mine.remove(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stashed within the block, by this thread, is deleted at its end: write the results that read it before that.

    Outside of any block stashes stay until their owner deletes the folder, as DataFrames that read them may be kept.
    """
    mine: list[str] = []
    token = _scope.set(mine)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in mine:
            drop(spark, path)


def stash_path(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(stash_path(df, name))
