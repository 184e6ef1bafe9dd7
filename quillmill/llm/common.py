"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: \x20 and \x09-\x0D: the white space that the line and word rules know.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone: other columns, whatever their names, never reach an operator; a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def text_key(text_col: str = "text") -> Column:
    """What stands for a row where its text alone decides: a 64-bit hash of it, which rows have whether or not they have an id; null is empty."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where it is unset and all of Spark is one local process, as in tests."""
    context = spark.sparkContext
    if folder := context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not context._jsc.sc().getCheckpointDir().isEmpty():
        return context._jsc.sc().getCheckpointDir().get()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-shared-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with one reliable copy in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def partitions(spark: SparkSession, at_least: float = 1) -> int:
    """As many as the session shuffles into, or more if the data ask for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(np.ceil(at_least)))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256, size: int = 1 << 22) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) of a few rows at a time, of about so many bytes at most, so that no task holds a whole partition's texts as Python objects."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(pc.binary_length(texts.slice(at, rows)).to_numpy(zero_copy_only=False))
            n = max(1, int(np.searchsorted(ends, size, "right")))
            yield ids.slice(at, n).to_pylist(), texts.slice(at, n).to_pylist()
            at += n


def by_hash(df: DataFrame, bound: int, *keys: str) -> DataFrame:
    """A bounded sample of rows that depends on their keys alone, not on partitions."""
    return df.orderBy(F.xxhash64(*keys), *keys).limit(bound)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a long, b long) as (node, root), root the smallest node reachable; nodes without edges are absent.

    Alternates the large-star and small-star steps: each node's larger neighbours, then its smaller ones, are hung
    on the smallest. Both keep connectivity and need no more than a minimum per node and one join, so a hub's
    edges can be split among tasks. A constant number of rows (a count and a checksum) comes to the driver.
    A round's edges are written as a table: a checkpoint computes its last stage twice, and is read in as many tasks again.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def written(df: DataFrame) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
