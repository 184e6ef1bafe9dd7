"""Do prompts say what their image's file is named after? Categories per row, and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import leading_phrase, slug_words, topic_slug

# Categories.
IN_PROMPT = "co_trong_prompt"
MISSING_TARGET_HAS = "thieu__target_co"
MISSING_TARGET_LACKS = "thieu__target_khong_co"
CATEGORIES = (IN_PROMPT, MISSING_TARGET_HAS, MISSING_TARGET_LACKS)


def classify(key: Column, prompt: Column, target_text: Column) -> Column:
    """struct<category, term>: the term is the longest leading phrase that the target has, and the prompt needs one as long; if the target has none, any."""
    n_words = lambda s: F.size(F.split(s, " "))
    said, shown = leading_phrase(key, F.coalesce(prompt, F.lit(""))), leading_phrase(key, F.coalesce(target_text, F.lit("")))
    enough = F.coalesce(n_words(said) >= n_words(shown), F.lit(False))
    category = F.when(shown.isNotNull(), F.when(enough, IN_PROMPT).otherwise(MISSING_TARGET_HAS)).otherwise(F.when(said.isNotNull(), IN_PROMPT).otherwise(MISSING_TARGET_LACKS))
    return F.struct(category.alias("category"), F.coalesce(shown, F.array_join(slug_words(key), " ")).alias("term"))


def cube(rows: DataFrame, split: str = "split", mode: str = "mode", category: str = "category") -> DataFrame:
    """Rows of each category per split and mode, with 'all' margins."""
    counts = [F.count_if(F.col(category) == c).alias(c) for c in CATEGORIES]
    name = lambda c: F.when(F.grouping(c) == 1, "all").otherwise(F.coalesce(F.col(c), F.lit("?"))).alias(c)
    return rows.cube(split, mode).agg(F.grouping(split).alias("_s"), F.grouping(mode).alias("_m"), F.count("*").alias("n"), *counts).select(F.when(F.col("_s") == 1, "all").otherwise(F.col(split)).alias(split), F.when(F.col("_m") == 1, "all").otherwise(F.col(mode)).alias(mode), "n", *CATEGORIES)


def by_topic(rows: DataFrame, key: str = "id", category: str = "category") -> DataFrame:
    """Per topic: rows, rows without the term, and their ratio (4 decimals)."""
    gone = F.count_if(F.col(category) != IN_PROMPT)
    return rows.groupBy(topic_slug(F.col(key)).alias("slug")).agg(F.count("*").alias("n"), gone.alias("n_missing"), F.round(gone / F.count("*"), 4).alias("miss_ratio"))


def worst_topics(rows: DataFrame, n: int = 20, key: str = "id", category: str = "category") -> DataFrame:
    """Topics that miss most: by ratio, then rows, then name; those that miss nothing left out."""
    return by_topic(rows, key, category).where("n_missing > 0").orderBy(F.desc("miss_ratio"), F.desc("n"), "slug").limit(n)


def images_missing(rows: DataFrame, key: str = "id", category: str = "category") -> DataFrame:
    """Distinct images per category that misses."""
    return rows.where(F.col(category) != IN_PROMPT).groupBy(category).agg(F.count_distinct(key).alias("n_images"))


def by_language(rows: DataFrame, language: str = "language", category: str = "category") -> DataFrame:
    """Rows per missing category and language, most first."""
    return rows.where(F.col(category) != IN_PROMPT).groupBy(category, language).agg(F.count("*").alias("n")).orderBy(F.desc("n"), category, language)
