"""Seeded samples and leak-free splits by group, training rows, and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import composite_key, seeded_rank
from ..sources.files import scratch, write_guarded
from .caption import label_text, leftover_ids, without_ids

SPLITS = ("train", "val", "test")


def union_all(passed: DataFrame, corrected: DataFrame | None = None) -> DataFrame:
    """Both inputs' rows; a column that one lacks is null there."""
    return passed if corrected is None else passed.unionByName(corrected, allowMissingColumns=True)


def last_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key the row of largest order: what a dictionary built in that order would hold."""
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_last")).select(*keys, *(F.col(f"_last.{c}").alias(c) for c in cols))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 3407) -> DataFrame:
    """n rows without replacement, the same whatever the partitions; all of them if there are no more. Each task sends n at most."""
    return df.orderBy(seeded_rank(seed, F.col(key)), key).limit(n)


def split_sizes(total: int, val: int = 700, test: int = 700, val_ratio: float | None = None, test_ratio: float | None = None) -> tuple[int, int]:
    """Groups of validation and test; ratios round half to even; if both would take everything, a tenth each, one at least."""
    v = round(val_ratio * total) if val_ratio is not None else val
    t = round(test_ratio * total) if test_ratio is not None else test
    return (max(1, total // 10), max(1, total // 10)) if v + t >= total else (v, t)


def assign(ids: DataFrame, key: str, seed: int = 3407, **sizes) -> DataFrame:
    """(key, split): groups shuffled by the seed, the first to val, the next to test, the rest to train.

    Only the last group of test is looked for: groups up to it are so few (the sizes asked for), and each other group compares itself
    with their limits, so the whole is never sorted in one place.
    """
    groups = ids.select(key).distinct().withColumn("_rank", F.concat(seeded_rank(seed, F.col(key)), F.lit("|"), F.col(key).cast("string")))
    n_val, n_test = split_sizes(groups.count(), **sizes)
    limit = lambda n: _nth(groups, n)
    first, second = limit(n_val), limit(n_val + n_test)
    up_to = lambda x: F.col("_rank") <= x if x is not None else F.lit(False)
    return groups.select(key, F.when(up_to(first), "val").when(up_to(second), "test").otherwise("train").alias("split"))


def _nth(groups: DataFrame, n: int) -> str | None:
    """The n-th smallest rank: buckets of ranks are counted, then one bucket is sorted."""
    if n <= 0:
        return None
    bucket = F.substring("_rank", 1, 3)
    before = 0
    for b, size in sorted(groups.groupBy(bucket.alias("b")).count().collect()):  # 4096 rows at most
        if before + size >= n:
            inside = groups.where(bucket == b).orderBy("_rank").limit(n - before)
            return inside.agg(F.max("_rank")).first()[0]
        before += size
    return groups.agg(F.max("_rank")).first()[0]


def training_rows(passed: DataFrame, targets: DataFrame, subs: DataFrame, splits: DataFrame) -> DataFrame:
    """Passed rows with their target (by id), their sub_json (by id and level) and their split; status tells what a row lacks, the target first."""
    t = targets.select("id", "target_json", F.col("target_json").isNotNull().alias("_target"))
    s = subs.select("id", "detail_level", F.struct("chu_de_chinh", "groups", "background", "style", "medium", "checklist").alias("sub_json"), F.lit(True).alias("_sub"))
    out = passed.join(t, "id", "left").join(s, ["id", "detail_level"], "left").join(splits, "id", "left")
    # By marks of their own, so that what only counts rows moves no targets.
    status = F.when(~F.coalesce("_target", F.lit(False)), "no target").when(F.col("_sub").isNull(), "no sub_json").otherwise("ok")
    return out.withColumn("status", status).drop("_target", "_sub").withColumnRenamed("detail_level", "mode")


def finalise(rows: DataFrame, target: str = "target_json") -> DataFrame:
    """The label form of each row's target; no row is dropped and no prompt is changed."""
    return rows.withColumn(target, without_ids(F.col(target)))


def finalised(rows: DataFrame, target: str = "target_json", path: str | None = None) -> tuple[DataFrame, dict]:
    """finalise() written, and how many ids were stripped and remain, counted in the same job. One that remains fails the call and leaves nothing."""
    path = path or scratch(rows.sparkSession)
    counts = {"rows": F.count(F.lit(1)), "stripped": F.coalesce(F.sum("_had"), F.lit(0)), "remaining": F.coalesce(F.sum("_left"), F.lit(0))}
    out = finalise(rows.withColumn("_had", leftover_ids(F.to_json(target))), target).withColumn("_left", leftover_ids(label_text(F.col(target))))
    seen = write_guarded(out, path, counts, lambda n: f"{n['remaining']} ids remain in the labels" if n["remaining"] else None, drop=["_had", "_left"])
    return rows.sparkSession.read.parquet(path), seen


def split_report(rows: DataFrame, split: str = "split", mode: str = "mode", group: str = "id") -> DataFrame:
    """Per split: rows, rows of each mode, distinct groups."""
    return rows.groupBy(split).agg(F.count("*").alias("n_rows"), *(F.count_if(F.col(mode) == m).alias(f"n_{m}") for m in ("short", "medium", "long")), F.count_distinct(group).alias("n_images"))


def leaks(rows: DataFrame, split: str = "split", group: str = "id") -> DataFrame:
    """Groups that more than one split holds."""
    return rows.groupBy(group).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def finalise_report(before: DataFrame, target: str = "target_json", split: str = "split") -> DataFrame:
    """Per split and in all (split 'all'): rows, ids stripped, ids that remain after."""
    label = F.col(target)
    counted = before.select(split, leftover_ids(F.to_json(label)).alias("had"), leftover_ids(label_text(without_ids(label))).alias("left"))
    return counted.rollup(split).agg(F.count("*").alias("n_rows"), F.sum("had").alias("n_stripped"), F.sum("left").alias("n_remaining")).withColumn(split, F.coalesce(F.col(split), F.lit("all")))


def strided_shard(df: DataFrame, order: str, world: int) -> DataFrame:
    """Rows dealt in turn by an order column that numbers them: shard = order mod world."""
    return df.withColumn("shard", F.pmod(F.col(order), F.lit(world)))


def numbered(df: DataFrame, order: list[str], name: str = "ord") -> DataFrame:
    """Rows numbered from 0 in an order: ranges are sorted apart and written once, as another run of them may cut them elsewhere; then their sizes are summed. No task gets all rows."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))  # a row for each partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", (before - F.col("_first")).alias("_shift"))
    return ranged.join(F.broadcast(starts), "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def key(row_id: Column, level: Column) -> Column:
    return composite_key(row_id, level)
