"""Roll-ups over captions and levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import percentiles
from ..functions.text import total_words, word_count
from .caption import elements, measures


def roll_up(captions: DataFrame, caption: str = "caption", errors: str = "errors") -> DataFrame:
    """One row: documents in, sound and faulty; elements, text elements and their ratio (5 decimals, 0 if none); distributions as
    structs, and the medians that richness is held against. Each distribution is counted per value on Spark; single rows are joined."""
    seen = captions.select(errors, *measures(F.col(caption)), F.transform(elements(F.col(caption)), lambda e: word_count(e["desc"])).alias("desc_words"))
    totals = seen.agg(
        F.count("*").alias("n_files_input"),
        F.count_if(F.size(errors) == 0).alias("n_files_ok"),
        F.count_if(F.size(errors) > 0).alias("n_files_schema_error"),
        F.coalesce(F.sum("n_elements"), F.lit(0)).alias("total_elements"),
        F.coalesce(F.sum("n_text_elements"), F.lit(0)).alias("text_elements"),
        F.coalesce(F.round(F.sum("n_text_elements") / F.nullif(F.sum("n_elements"), F.lit(0)), 5), F.lit(0.0)).alias("text_element_ratio"),
    )
    values = F.expr("stack(4, 'elements_per_image', array(n_elements), 'words_per_desc', desc_words, 'words_background', array(words_background), 'words_high_level', array(words_high_level)) as (name, vs)")
    shape = percentiles(seen.select(values).select("name", F.explode("vs").alias("v")), F.col("v"), ["name"])
    fields = ["min", "p25", "p50", "p75", "p90", "p99", "max", "mean"]
    named = shape.agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct(*fields)))).alias("distributions"))  # four rows
    out = totals.withColumn("_one", F.lit(1)).join(named.withColumn("_one", F.lit(1)), "_one").drop("_one")
    of = lambda name: F.try_element_at("distributions", F.lit(name))["p50"]
    return out.withColumns({"median_elements": of("elements_per_image"), "median_words_per_desc": of("words_per_desc")})


def level_summary(rows: DataFrame, level: str = "detail_level") -> DataFrame:
    """Per level: rows, and mean groups, facts and words of the checklist (2 decimals)."""
    facts = F.size("checklist")
    total = total_words(F.col("checklist"))
    return rows.groupBy(level).agg(F.count("*").alias("n"), F.round(F.avg(F.size("groups")), 2).alias("mean_groups"), F.round(F.avg(facts), 2).alias("mean_facts"), F.round(F.avg(total), 2).alias("mean_words"))


def facts_histogram(rows: DataFrame, level: str = "detail_level") -> DataFrame:
    return rows.groupBy(level, F.size("checklist").alias("n_facts")).agg(F.count("*").alias("n")).orderBy(level, "n_facts")


def selection_summary(evaluated: DataFrame) -> DataFrame:
    """One row: images, rows (levels kept), images with some but not all levels, and drops of each level."""
    dropped = lambda k: F.count_if(F.exists("dropped", lambda d: d["level"] == k)).alias(f"dropped_{k}")
    n = F.size("levels")
    return evaluated.agg(F.count("*").alias("n_images"), F.coalesce(F.sum(n), F.lit(0)).alias("n_rows"), F.count_if((n > 0) & (n < 3)).alias("n_partial"), *map(dropped, ("short", "medium", "long")))
