"""Plan helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for each row.

    Projections over one another are merged, and an expression that a later one uses in a lambda is then computed for each element, and
    nested ones for each element of an element. A one-row generator stands between and keeps them apart; it shuffles nothing and leaves the JVM nowhere.
    """
    held = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("_once")
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, held).select(*kept, *(F.col(f"_once.{n}").alias(n) for n in columns))


def small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """df, to be broadcast if it has so few rows; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it: for lambdas, in which common parts are not found by the optimiser."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spread(df: DataFrame) -> DataFrame:
    """df dealt to as many tasks as the session runs at once, if it comes in fewer files than that: for work that is long for each row. Tables of many files are left as they are, so nothing large is moved."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n else df
