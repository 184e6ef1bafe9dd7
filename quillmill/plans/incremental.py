"""Incremental recomputation: results kept by key and fingerprint of their input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import scratch, write_guarded


def canonical(text: Column) -> Column:
    """JSON text with the keys of every object sorted, without white space, and decimals without zeros at their end; text that does not parse fails the job."""
    return F.to_json(F.parse_json(text))


def fingerprint(*parts: Column) -> Column:
    """Of what a result depends on, whatever the order of fields at any depth; limits that only judge results are left out, so that changing them keeps results."""
    return F.sha1(canonical(F.to_json(F.struct(*parts))).cast("binary"))


def todo(rows: DataFrame, cache: DataFrame, keys: list[str], stamp: str = "fingerprint", retry: Column | None = None) -> DataFrame:
    """Rows without a current result: none by that key and fingerprint, or one that retry (on the cache's columns) asks again."""
    current = cache.where(~retry) if retry is not None else cache
    return rows.join(current.select(*keys, stamp).distinct(), [*keys, stamp], "left_anti")


def current(rows: DataFrame, cache: DataFrame, keys: list[str], stamp: str = "fingerprint") -> DataFrame:
    """Rows with their current result."""
    return rows.join(cache, [*keys, stamp])


def newest(cache: DataFrame, keys: list[str], better: list[Column]) -> DataFrame:
    """Per key the best row by these columns, so that a retry that did worse does not replace what it retried."""
    cols = [c for c in cache.columns if c not in keys]
    return cache.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*better)).alias("_best")).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in cols))


def matched(rows: DataFrame, others: DataFrame, key: str = "id", path: str | None = None) -> tuple[DataFrame, int]:
    """Rows with the others' columns by key, written in the job that counts how many had none there; no match at all fails the call and leaves nothing. The last of the others that share a key counts as it comes: make them unique first."""
    out = rows.join(others.withColumn("_there", F.lit(True)), key, "left")
    there = F.coalesce(F.col("_there"), F.lit(False))
    path = path or scratch(rows.sparkSession)
    seen = write_guarded(out, path, {"matched": F.count_if(there), "missing": F.count_if(~there)}, lambda n: None if n["matched"] else f"no {key} of the rows is among the others", there, drop=["_there"])
    return rows.sparkSession.read.parquet(path), seen["missing"]


def restricted(rows: DataFrame, sampled: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the sampled keys."""
    return rows.join(sampled.select(key), key, "left_semi")


def common(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Keys that both have, each once."""
    return a.select(key).intersect(b.select(key))


def failures_left(failures: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Failures of keys that gave no row after all."""
    return failures.join(rows.select(*keys).distinct(), keys, "left_anti")


def usable_levels(levels: Column, order: tuple[str, ...] = ("short", "medium", "long")) -> Column:
    """A cached entry's levels in order; entries from before levels were noted have all."""
    every = F.array(*map(F.lit, order))
    return F.filter(every, lambda x: F.array_contains(F.coalesce(levels, every), x))
