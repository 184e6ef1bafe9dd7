"""Walks through JSON of any depth as relations: a row for each value, level by level.

A level's children come from one lateral join with variant_explode, in the JVM; only objects and arrays go on to the next level, and each level is written
once to the shared folder, so nothing is parsed twice and there are as many jobs as levels. What lies in an object or array is written with it only at every HOPS-th level, from which
the next HOPS are taken: so a text is not written once for each level above it. Keys of an object come in their sorted order, as VARIANT holds them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.files import scratch
from .jsonx import DROPPED_KEYS


#: Levels from one whose objects and arrays are written whole to the next such.
HOPS = 4
CONTAINERS = ("object", "array")


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    both = F.to_json(F.array(text))
    return F.substring(both, F.lit(2), F.char_length(both) - 2)


def _kind(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    return F.when(value.isNull() | F.is_variant_null(value), "null").when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").otherwise("value")


@dataclass(frozen=True)
class Walk:
    """(key, parent, path, name, pos, kind, value) by level; the first level is the whole documents, whose path is empty. An object's or array's value may be left out (null)."""

    key: str
    levels: list[DataFrame]

    def nodes(self) -> DataFrame:
        out = self.levels[0]
        for more in self.levels[1:]:
            out = out.unionByName(more)
        return out

    def null_paths(self) -> DataFrame:
        """(key, path): a.b[2].c for each null; <root> where the whole is null."""
        return self.nodes().where("kind = 'null'").select(self.key, F.when(F.col("path") == "", "<root>").otherwise(F.col("path")).alias("path"))

    def keys(self) -> DataFrame:
        """(key, name): each document's keys at any depth, once."""
        return self.nodes().where("name is not null").select(self.key, "name").distinct()

    def leaves(self) -> DataFrame:
        """(key, path, value): what is neither object nor array, as text."""
        return self.nodes().where("kind in ('value', 'null')").select(self.key, "path", F.expr("try_variant_get(value, '$', 'string')").alias("value"))

    def rebuilt(self) -> DataFrame:
        """(key, json): the documents put together again from the deepest level up, minified, keys sorted; what the walk left out is not in them."""
        # A document's rows are dealt by its key once; objects and arrays are put together with what they hold where they lie, level by level.
        spark = self.levels[0].sparkSession
        dealt = lambda df: df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), self.key)
        held = F.col("kind").isin(*CONTAINERS)
        below = None
        for level in reversed(self.levels):
            values = dealt(level.where(~held).select(self.key, "parent", "name", "pos", F.coalesce(F.to_json("value"), F.lit("null")).alias("text")))
            whole = dealt(level.where(held).select(self.key, "path", F.struct("parent", "name", "pos", "kind").alias("of"))).select(self.key, "path", "of", F.lit(None).cast("struct<pos int, part string>").alias("part"))
            if below is not None:
                part = F.when(F.col("name").isNotNull(), F.concat(quoted(F.col("name")), F.lit(":"), F.col("text"))).otherwise(F.col("text"))
                of = F.lit(None).cast(whole.schema["of"].dataType)
                whole = whole.unionByName(below.select(self.key, F.col("parent").alias("path"), of.alias("of"), F.struct("pos", part.alias("part")).alias("part")))
            inner = F.array_join(F.array_sort(F.collect_list("part"))["part"], ",")
            put = whole.groupBy(self.key, "path").agg(F.any_value("of", True).alias("of"), inner.alias("inner"))
            text = F.when(F.col("of.kind") == "object", F.concat(F.lit("{"), F.col("inner"), F.lit("}"))).otherwise(F.concat(F.lit("["), F.col("inner"), F.lit("]")))
            below = values.unionByName(put.select(self.key, "of.parent", "of.name", "of.pos", text.alias("text")))
        return below.select(self.key, F.col("text").alias("json"))


def walk(rows: DataFrame, key: str, text: str, without: tuple[str, ...] = ()) -> Walk:
    """Of (key, JSON text), keys unique; texts that do not parse have no rows. without: keys that are left out wherever they stand, with all below them."""
    spark = rows.sparkSession
    none = F.lit(None).cast("string")
    level = rows.select(key, none.alias("parent"), F.lit("").alias("path"), none.alias("name"), F.lit(0).alias("pos"), F.try_parse_json(text).alias("value")).where("value is not null")
    levels = []
    while True:
        seen, folder = Observation(), scratch(spark)
        whole = len(levels) % HOPS == 0
        inside = F.col("kind").isin(*CONTAINERS)
        told = level.withColumn("kind", _kind(F.col("value"))).observe(seen, F.count_if(inside).alias("n"))
        (told if whole else told.withColumn("value", F.when(~inside, F.col("value")))).write.parquet(folder)
        levels.append(spark.read.parquet(folder))
        if not seen.get["n"]:
            return Walk(key, levels)
        # A value that is neither object nor array has nothing to explode.
        above = levels[-1].where(inside) if whole else level
        inner = above.select(F.col(key).alias("_k"), F.col("path").alias("parent"), F.col("value").alias("_v"))
        found = inner.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).drop("_v").withColumnRenamed("key", "name").withColumnRenamed("_k", key)
        path = F.when(F.col("name").isNull(), F.format_string("%s[%d]", "parent", "pos")).when(F.col("parent") == "", F.col("name")).otherwise(F.concat("parent", F.lit("."), "name"))
        level = found.where(~F.coalesce(F.col("name").isin(*without), F.lit(False)) if without else F.lit(True)).select(key, "parent", path.alias("path"), "name", "pos", "value")


def without_keys(rows: DataFrame, key: str, text: str, keys: tuple[str, ...] = DROPPED_KEYS) -> DataFrame:
    """(key, json): the documents without these keys at any depth, keys sorted."""
    return walk(rows, key, text, keys).rebuilt()
