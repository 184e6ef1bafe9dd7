"""Queries on choosing facts by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import total_words
from ..operators import audit, persona, selection
from .adapters import SELECTING, selectable, wc
from .registry import query, table


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.evaluate(selectable(spark, sf_dir), "selection", "sel_input")


@query(f"{SELECTING} SELECT id, array_to_string(list_transform(groups, lambda g: g.name || '/' || g.card || '/' || len(g.elements) || '/' || len(flatten(g.elements))), '|') AS groups, array_to_string(bg, '|') AS background, array_to_string(list_transform(style, lambda s: s.field || '=' || array_to_string(s.facts, ',')), '|') AS style FROM sel")
def selection_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("sel_input")
    group = lambda g: F.concat_ws("/", g["name"], g["cardinality"], F.size(g["elements"]).cast("string"), F.size(F.flatten(g["elements"])).cast("string"))
    return selectable(spark, sf_dir).select("id", F.array_join(F.transform(i["groups"], group), "|").alias("groups"), F.array_join(i["background"], "|").alias("background"), F.array_join(F.transform(i["style"], lambda s: F.concat_ws("=", s["field"], F.array_join(s["facts"], ","))), "|").alias("style"))


@query(f"{SELECTING} SELECT id, short_w, medium_w, short_w > 20 AS short_over, medium_w > 55 AS medium_over FROM judged")
def word_cap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluated(spark, sf_dir).select("id", F.col("words_short").alias("short_w"), F.col("words_medium").alias("medium_w"))
    return rows.select("*", (F.col("short_w") > selection.ACCEPTED_WORDS["short"]).alias("short_over"), (F.col("medium_w") > selection.ACCEPTED_WORDS["medium"]).alias("medium_over"))


@query(f"{SELECTING} SELECT id, ideas, len(short_s) AS n_style, ideas > 2 OR len(short_s) > 0 AS broken FROM judged")
def short_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    read, ideas = F.col("read_short"), F.col("ideas_short")
    return evaluated(spark, sf_dir).select("id", ideas.alias("ideas"), F.size(read["style"]).alias("n_style"), ((ideas > selection.SHORT_MAX_IDEAS) | (F.size(read["style"]) > 0)).alias("broken"))


@query(f"{SELECTING} SELECT id, short_lost_medium + len(short_s) AS short_medium, CASE WHEN long_there THEN medium_lost_long + 0 END AS medium_long FROM judged")
def nesting_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = {k: F.col(f"read_{k}") for k in selection.LEVELS}
    n = lambda a, b: F.size(selection.nesting(a, b, read[a], read[b]))
    return evaluated(spark, sf_dir).select("id", n("short", "medium").alias("short_medium"), F.when(read["long"]["usable"], n("medium", "long")).alias("medium_long"))


@query(f"{SELECTING} SELECT id, array_to_string(list_filter([CASE WHEN keep_short THEN 'short' END, CASE WHEN keep_medium THEN 'medium' END, CASE WHEN long_ok THEN 'long' END], lambda x: x IS NOT NULL), ',') AS levels FROM judged")
def kept_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(spark, sf_dir).select("id", F.array_join("levels", ",").alias("levels"))


_LEVELS = """levels AS (
  SELECT id, 'short' AS detail_level, short_c AS c, short_g AS g FROM judged WHERE keep_short
  UNION ALL SELECT id, 'medium', medium_c, medium_g FROM judged WHERE keep_medium
  UNION ALL SELECT id, 'long', long_c, long_g FROM judged WHERE long_ok)"""


@query(f"{SELECTING}, {_LEVELS} SELECT id, detail_level, len(g) AS n_groups, array_to_string(c, '|') AS checklist, list_sum(list_transform(c, lambda x: {wc('x')}))::BIGINT AS words FROM levels")
def level_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.assemble(evaluated(spark, sf_dir))
    return rows.select("id", "detail_level", F.size("groups").alias("n_groups"), F.array_join("checklist", "|").alias("checklist"), total_words(F.col("checklist")).alias("words"))


@query(f"{SELECTING}, {_LEVELS} SELECT detail_level, count(*) AS n, round(avg(len(g)), 2) AS mean_groups, round(avg(len(c)), 2) AS mean_facts, round(avg(list_sum(list_transform(c, lambda x: {wc('x')}))), 2) AS mean_words FROM levels GROUP BY detail_level")
def level_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.level_summary(selection.assemble(evaluated(spark, sf_dir)))


@query(f"{SELECTING} SELECT count(*) AS n_images, sum(k)::BIGINT AS n_rows, count(*) FILTER (WHERE k > 0 AND k < 3) AS n_partial, count(*) FILTER (WHERE NOT keep_short) AS dropped_short, count(*) FILTER (WHERE NOT keep_medium) AS dropped_medium, count(*) FILTER (WHERE NOT long_ok) AS dropped_long FROM (SELECT *, keep_short::INT + keep_medium::INT + long_ok::INT AS k FROM judged)")
def selection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.selection_summary(evaluated(spark, sf_dir))


@query("""WITH firsts AS (SELECT o_custkey, list(o_orderpriority ORDER BY o_orderkey) AS a, list(o_orderstatus ORDER BY o_orderkey) AS b FROM orders GROUP BY o_custkey)
SELECT o_custkey, array_to_string(list_filter(list_concat(a, b), lambda x, i: list_position(list_concat(a, b), x) = i), '|') AS checklist FROM firsts""")
def checklist_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists joined, each text once, where it first stands."""
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus"))).alias("xs"))
    both = F.concat(F.transform("xs", lambda x: x["o_orderpriority"]), F.transform("xs", lambda x: x["o_orderstatus"]))
    return rows.select("o_custkey", F.array_join(F.array_distinct(both), "|").alias("checklist"))


@query(f"""{SELECTING}, {_LEVELS},
draws AS (SELECT id, detail_level, id || '__' || detail_level AS key, ('0x' || left(md5('3407|role|' || id || '__' || detail_level), 8))::BIGINT / 4294967296.0 AS r, ('0x' || left(md5('3407|tone|' || id || '__' || detail_level), 8))::BIGINT / 4294967296.0 AS t, ('0x' || left(md5('3407|language|' || id || '__' || detail_level), 8))::BIGINT / 4294967296.0 AS l FROM levels)
SELECT key, CASE WHEN r < 0.6 THEN 'user phổ thông' WHEN r < 0.7 THEN 'designer' WHEN r < 0.8 THEN 'khách ngành cưới - sự kiện' WHEN r < 0.9 THEN 'sinh viên làm đồ án' ELSE 'nhân viên marketing' END AS vai,
  ['mô tả trung tính', 'ra lệnh', 'kể lể lan man'][1 + floor(t * 3)::INT] AS giong, l < 0.2 AS english FROM draws""")
def persona_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = selection.assemble(evaluated(spark, sf_dir)).select(F.concat_ws("__", "id", "detail_level").alias("key"))
    p = rows.withColumn("p", persona.persona(F.col("key")))
    return p.select("key", F.col("p")["vai"].alias("vai"), F.col("p")["giọng"].alias("giong"), (F.col("p")["ngôn ngữ"] == persona.ENGLISH).alias("english"))


@query(f"{SELECTING}, {_LEVELS} SELECT id, detail_level, list_sum(list_transform(c, lambda x: {wc('x')}))::BIGINT AS spec_words FROM levels")
def writer_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a writer gets holds the checklist's words, no more and no less, repeats aside."""
    rows = selection.assemble(evaluated(spark, sf_dir))
    sub = F.struct(*[F.col(c) for c in rows.columns])
    spec = persona.content(sub)
    none = F.array().cast("array<string>")
    every = F.concat(F.coalesce(spec["chu_de_chinh"], none), F.flatten(F.transform(spec["groups"], lambda g: g["facts"])), F.coalesce(spec["boi_canh"], none), F.coalesce(spec["phong_cach"], none))
    return rows.select("id", "detail_level", total_words(F.array_distinct(every)).cast("long").alias("spec_words"))


@query("SELECT o_custkey, attempt, levels FROM (SELECT o_custkey, o_orderkey AS attempt, o_orderkey % 4 AS levels, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 4 DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.slice(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), F.lit(1), (F.col("o_orderkey") % 4).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("attempt"), kept.alias("kept"))
    return selection.best_attempt(rows, "o_custkey", "kept", "attempt").select("o_custkey", "attempt", F.size("kept").cast("long").alias("levels"))
