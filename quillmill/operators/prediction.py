"""Predictions: pick rows, read answers, merge results in the order of the test rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import extracted_object
from ..functions.text import composite_key
from . import split


def chosen(rows: DataFrame, modes: list[str] | None = None, limit: int | None = None, order: str = "ord") -> DataFrame:
    """Rows of these modes, the first so many in order; no limit if it is none or 0."""
    out = rows.where(F.col("mode").isin(modes)) if modes else rows
    return out.orderBy(order).limit(limit) if limit else out


def record(answers: DataFrame, variant: str, max_new_tokens: int) -> DataFrame:
    """answers (id, mode, user_prompt, raw_output, n_input_tokens, n_output_tokens, gen_seconds, and target_json and sub_json where they are) as predictions: with the variant, the object in
    the answer or why there is none, and whether the answer used up its tokens."""
    found = extracted_object(F.col("raw_output"))
    carried = [c for c in ("target_json", "sub_json") if c in answers.columns]
    return answers.withColumn("_found", found).select(
        "id",
        "mode",
        F.lit(variant).alias("variant"),
        "user_prompt",
        "raw_output",
        F.col("_found")["json"].alias("pred_json"),
        F.col("_found")["error"].alias("parse_error"),
        "n_input_tokens",
        "n_output_tokens",
        (F.col("n_output_tokens") >= max_new_tokens).alias("hit_max_new_tokens"),
        F.round("gen_seconds", 2).alias("gen_seconds"),
        *carried,
    )


def variants(adapter: bool, baseline: bool) -> list[str]:
    """Which variants are run, in order: with the adapter, then without. None at all is an error."""
    out = [name for name, wanted in (("adapter", adapter), ("baseline", baseline)) if wanted]
    if not out:
        raise ValueError("ask for at least one variant")
    return out


def each_variant(rows: DataFrame, names: list[str], run: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Predictions of all variants: run answers rows as one variant, whose name is a literal of its rows."""
    out = None
    for name in names:
        one = run(rows, name).withColumn("variant", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def merge(tests: DataFrame, predictions: DataFrame) -> DataFrame:
    """Test rows with their prediction; those without one are left out."""
    held = predictions.withColumn("key", composite_key(F.col("id"), F.col("mode"))).drop("id", "mode")
    return tests.withColumn("key", composite_key(F.col("id"), F.col("mode"))).join(held, "key")


def write_in_order(rows: DataFrame, path: str, order: list[str], per_file: int = 100_000) -> DataFrame:
    """Writes rows as JSON lines in an order, so many a file: folder file=0 holds the first, and each row its place in it. Gives the manifest, (file, n_rows, first, last), which is
    written beside the files. Rows are numbered by ranges, and a file is written by a task of its own."""
    spark = rows.sparkSession
    placed = split.numbered(rows, order, "_ord").withColumns({"file": F.floor(F.col("_ord") / per_file), "place": F.col("_ord") % per_file})
    placed.drop("_ord").repartition("file").sortWithinPartitions("file", "place").write.mode("overwrite").partitionBy("file").json(path)
    manifest = spark.read.schema("file long, place long").json(path).groupBy("file").agg(F.count("*").alias("n_rows"), F.min("place").alias("first"), F.max("place").alias("last"))
    manifest.coalesce(1).write.json(f"{path}/_manifest")
    return spark.read.schema("file long, n_rows long, first long, last long").json(f"{path}/_manifest")


def read_in_order(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What write_in_order wrote, with file and place; a file whose rows are not what the manifest says fails the job."""
    rows = spark.read.schema(f"{schema}, place long, file long").json(path)
    said = spark.read.schema("file long, n_rows long").json(f"{path}/_manifest")
    wrong = rows.groupBy("file").count().join(said, "file", "full").where("count is null or n_rows is null or count <> n_rows").limit(1).collect()
    if wrong:
        raise ValueError(f"file {wrong[0]['file']} of {path} has {wrong[0]['count']} rows, not {wrong[0]['n_rows']}")
    return rows


def merge_counts(tests: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: written, missing, parse_failed, truncated."""
    held = predictions.select(composite_key(F.col("id"), F.col("mode")).alias("key"), F.lit(True).alias("there"), "parse_error", "hit_max_new_tokens")
    out = tests.select(composite_key(F.col("id"), F.col("mode")).alias("key")).join(held, "key", "left")
    there = F.coalesce(F.col("there"), F.lit(False))
    return out.agg(F.count_if(there).alias("written"), F.count_if(~there).alias("missing"), F.count_if(there & F.col("parse_error").isNotNull()).alias("parse_failed"), F.count_if(there & F.coalesce("hit_max_new_tokens", F.lit(False))).alias("truncated"))
