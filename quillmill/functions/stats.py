"""Order statistics by rank, from counts per value.

Values are counted map-side first and only distinct values meet in a group, so a group may hold any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}


def _ranked(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """A row per group and value, with how many rows have at most that value, and how many there are."""
    counted = df.select(*keys, value.alias("v")).where("v is not null").groupBy(*keys, "v").agg(F.count("*").alias("n"))
    up = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("upto", F.sum("n").over(up)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))


def _at(rank: Column) -> Column:
    """The value of that rank, counted from 0."""
    return F.min(F.when(F.col("upto") > rank, F.col("v")))


def percentiles(df: DataFrame, value: Column, keys: list[str] | None = None) -> DataFrame:
    """min, p25, p50, p75, p90, p99, max and mean (2 decimals) per group. A percentile q of n values is the one of rank
    floor(q (n - 1)), counted from 0; a group without values gives no row, and without keys there is one row, of nulls if there are no values."""
    ranked = _ranked(df, keys or [], value)
    total = F.sum(F.col("v") * F.col("n")) / F.max("total")
    return ranked.groupBy(*(keys or [])).agg(
        F.min("v").alias("min"),
        *(_at(F.floor(F.lit(q) * (F.col("total") - 1))).alias(name) for name, q in QUANTILES.items()),
        F.max("v").alias("max"),
        F.round(total, 2).alias("mean"),
    )


def length_summary(df: DataFrame, value: Column, keys: list[str]) -> DataFrame:
    """n, mean (2 decimals), the upper median (rank n div 2, counted from 0), min and max per group."""
    return _ranked(df, keys, value).groupBy(*keys).agg(
        F.max("total").alias("n"),
        F.round(F.sum(F.col("v") * F.col("n")) / F.max("total"), 2).alias("mean"),
        _at(F.floor(F.col("total") / 2)).alias("median"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
