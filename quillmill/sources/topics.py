"""The topic dimension, and prompts by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import small
from ..functions.text import slug_words, topic_slug
from .files import exists

TOPIC = "slug string, thuat_ngu string, dong_nghia array<string>"


def topics(spark: SparkSession, path: str | None) -> DataFrame:
    """(slug, thuat_ngu, dong_nghia) from a JSON file's list of topics; those without a slug left out; no file, or none there, no topics."""
    if path is None or not exists(spark, path):
        return spark.createDataFrame([], TOPIC)
    read = spark.read.schema(f"topics array<struct<{TOPIC.replace(' string', ': string').replace(' array', ': array')}>>").option("multiLine", True).json(path)
    return read.select(F.inline("topics")).where("coalesce(slug, '') <> ''")


def with_hint(rows: DataFrame, dimension: DataFrame, key: str = "id") -> DataFrame:
    """rows with goi_y_chu_de: the slug's words, and term and synonyms where the topic is known."""
    out = rows.withColumn("slug", topic_slug(F.col(key))).join(small(dimension.dropDuplicates(["slug"])), "slug", "left")
    return out.withColumn("goi_y_chu_de", hint(F.col(key), F.col("thuat_ngu"), F.col("dong_nghia"))).drop("slug", "thuat_ngu", "dong_nghia")


def hint(key: Column, term: Column, synonyms: Column) -> Column:
    return F.struct(F.array_join(slug_words(key), " ").alias("ten_thu_muc"), term.alias("thuat_ngu"), F.when(term.isNotNull(), synonyms).alias("dong_nghia"))


def system_prompts(spark: SparkSession, folder: str | None, defaults: dict[str, str]) -> DataFrame:
    """(level, system, origin): a file <level>.txt of the folder, else the default."""
    base = spark.createDataFrame(list(defaults.items()), "level string, default string")
    if folder is None:
        return base.select("level", F.col("default").alias("system"), F.lit("default").alias("origin"))
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(F.regexp_replace(F.col("_metadata.file_name"), "\\.txt$", "").alias("level"), F.col("value").alias("own"))
    own = F.trim(F.coalesce("own", F.lit(""))) != ""
    return base.join(small(files), "level", "left").select("level", F.when(own, F.col("own")).otherwise(F.col("default")).alias("system"), F.when(own, "file").otherwise("default").alias("origin"))
