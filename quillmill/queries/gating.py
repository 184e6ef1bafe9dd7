"""Queries on the gate, corrections, splits and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import reason_label
from ..operators import caption, coverage, gate, split
from .adapters import CAPS, GATE, captions, prompts, verdicts
from .registry import query, table


def decided(spark: SparkSession, sf_dir: str, bypass: bool = False) -> DataFrame:
    v = verdicts(spark, sf_dir)
    v = v.withColumns({"missing": gate.missing_items(F.col("raw_missing")), "extra": gate.extra_items(F.col("raw_extra"))})
    judged = F.col("quality").isNotNull()
    return v.withColumn("decision", F.when(judged | F.lit(bypass), gate.decide(F.col("missing"), F.col("extra"), F.col("required"))))


@query(f"""{GATE} SELECT doc_id, CASE WHEN n_core = 1 THEN w || '/cot_loi' WHEN n_minor = 1 THEN source || '/phu' ELSE '' END AS missing, CASE WHEN n_hard = 1 THEN lang || '/them_vat_the' WHEN n_soft = 1 THEN source || '/cam_nhan' ELSE '' END AS extra FROM verdicts WHERE is_judged""")
def verdict_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = verdicts(spark, sf_dir).where("quality is not null")
    line = lambda items, key: F.array_join(F.transform(items, lambda i: F.concat_ws("/", i[key], i["muc_do"])), "|")
    return v.select("doc_id", line(gate.missing_items(F.col("raw_missing")), "menh_de").alias("missing"), line(gate.extra_items(F.col("raw_extra")), "thong_tin").alias("extra"))


_REASONS = "list_filter([CASE WHEN lost THEN 'theme lost: ' || w WHEN n_core > 0 THEN 'missing 1 core facts' END, CASE WHEN n_hard > 0 THEN 'adds 1 facts' END], lambda x: x IS NOT NULL)"


@query(f"{GATE} SELECT doc_id, is_passed AS passed, array_to_string({_REASONS}, '; ') AS reasons FROM verdicts WHERE is_judged")
def gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(spark, sf_dir).where("decision is not null").select("doc_id", "decision.passed", F.array_join("decision.reasons", "; ").alias("reasons"))


@query(f"{GATE} SELECT count(*) AS n_input, count(*) FILTER (WHERE is_judged) AS n_judged, count(*) FILTER (WHERE is_passed) AS n_passed, count(*) FILTER (WHERE is_judged AND NOT is_passed) AS n_rejected, round(count(*) FILTER (WHERE is_passed) / count(*) FILTER (WHERE is_judged), 4) AS pass_rate, count(*) FILTER (WHERE is_passed AND n_minor > 0) AS n_passed_with_minor, count(*) FILTER (WHERE is_passed AND n_soft > 0) AS n_passed_with_soft FROM verdicts")
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.report(decided(spark, sf_dir))


@query(f"{GATE} SELECT level, count(*) AS n, count(*) FILTER (WHERE is_passed) AS passed, round(count(*) FILTER (WHERE is_passed) / count(*), 4) AS pass_rate FROM verdicts GROUP BY level")
def gate_report_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.report_by_level(decided(spark, sf_dir), "level")


@query(f"{GATE} SELECT source AS text, count(*) AS n FROM verdicts WHERE is_judged AND n_minor = 1 GROUP BY source ORDER BY n DESC, min(doc_id) LIMIT 5")
def top_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.top_texts(decided(spark, sf_dir), "missing_phu", 5)


@query(f"{GATE} SELECT trim(regexp_replace(string_split(r, ':')[1], '\\s*\\d+\\s+', ' ', 'g')) AS reason, count(*) AS n FROM (SELECT unnest({_REASONS}) AS r FROM verdicts WHERE is_judged) GROUP BY reason")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.reason_counts(decided(spark, sf_dir))


@query(f"{GATE} SELECT count(*) AS n_input, count(*) FILTER (WHERE NOT is_judged OR is_passed) AS n_passed FROM verdicts")
def gate_bypass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate bypassed: rows that were not judged pass, verdicts that are there still hold."""
    v = verdicts(spark, sf_dir)
    held = v.where("quality is not null").select("doc_id", gate.missing_items(F.col("raw_missing")).alias("missing"), gate.extra_items(F.col("raw_extra")).alias("extra"))
    rows = gate.with_verdicts(v.select("doc_id", "required"), held, ["doc_id"], bypass=True)
    passed = gate.decide(F.col("missing"), F.col("extra"), F.col("required"))["passed"]
    return rows.agg(F.count("*").alias("n_input"), F.count_if(passed).alias("n_passed"))


@query(f"{GATE} SELECT count(*) AS n_attempted, count(*) FILTER (WHERE doc_id % 2 = 0) AS n_recovered, count(*) FILTER (WHERE doc_id % 2 = 1) AS n_rejected_final, round(count(*) FILTER (WHERE doc_id % 2 = 0) / count(*), 4) AS recovery_rate FROM verdicts WHERE is_judged AND NOT is_passed")
def correction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows corrected; every other correction passes."""
    return gate.correction_report(decided(spark, sf_dir).where("not decision.passed").withColumn("passed", F.col("doc_id") % 2 == 0))


def _passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decided(spark, sf_dir).where("decision is not null")
    good = rows.where("decision.passed").select("doc_id", "id", "level", F.col("prompt").alias("user_prompt"), "lang")
    bad = rows.where("not decision.passed").where("doc_id % 2 = 0").select("doc_id", "id", "level", F.col("prompt").alias("user_prompt"), "lang", F.concat(F.lit(" fixed  "), F.col("prompt")).alias("answer"))
    fixed = gate.corrected(bad, answer="answer")
    return split.union_all(good, fixed)


_PASSED = "passed AS (SELECT doc_id, id, level, prompt AS user_prompt, lang, NULL::BOOLEAN AS corrected, NULL AS original_prompt FROM verdicts WHERE is_passed UNION ALL SELECT doc_id, id, level, trim('fixed ' || prompt), lang, true, prompt FROM verdicts WHERE is_judged AND NOT is_passed AND doc_id % 2 = 0)"


@query(f"{GATE}, {_PASSED} SELECT doc_id, level, user_prompt, coalesce(corrected, false) AS corrected, original_prompt FROM passed")
def union_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passed(spark, sf_dir).select("doc_id", "level", "user_prompt", F.coalesce("corrected", F.lit(False)).alias("corrected"), "original_prompt")


_SPLIT = """split_of AS (SELECT id, CASE WHEN r <= n_val THEN 'val' WHEN r <= n_val + n_test THEN 'test' ELSE 'train' END AS split FROM (
  SELECT id, row_number() OVER (ORDER BY md5('3407|' || id) || '|' || id) AS r, round_even(0.1 * count(*) OVER (), 0) AS n_val, round_even(0.15 * count(*) OVER (), 0) AS n_test FROM (SELECT DISTINCT id FROM ids)))"""


@query(f"WITH {CAPS}, ids AS (SELECT id FROM caps), {_SPLIT} SELECT id, split FROM split_of")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign(captions(spark, sf_dir), "id", val_ratio=0.1, test_ratio=0.15)


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _passed(spark, sf_dir).withColumnRenamed("level", "detail_level")
    caps = captions(spark, sf_dir, dealt=False)
    targets = caps.where("doc_id % 29 <> 0").select("id", caption.with_ids(F.col("caption")).alias("target_json"))
    none = F.array().cast("array<string>")
    subs = caps.where("doc_id % 31 <> 0").select("id", F.get(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), (F.col("doc_id") % 3).cast("int")).alias("detail_level"), none.alias("chu_de_chinh"), none.alias("groups"), none.alias("background"), none.alias("style"), F.lit("m").alias("medium"), F.array("lang").alias("checklist"))
    splits = split.assign(rows, "id", val_ratio=0.1, test_ratio=0.15)
    return split.training_rows(rows, targets, subs, splits)


_TRAIN = f"{GATE}, {_PASSED}, ids AS (SELECT id FROM passed), {_SPLIT}, training AS (SELECT p.*, s.split, CASE WHEN p.doc_id % 29 = 0 THEN 'no target' WHEN p.doc_id % 31 = 0 THEN 'no sub_json' ELSE 'ok' END AS status FROM passed p JOIN split_of s USING (id))"


@query(f"{_TRAIN} SELECT id, level AS mode, user_prompt, status, split, CASE WHEN status = 'ok' THEN lang END AS checklist FROM training")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(spark, sf_dir)
    return rows.select("id", "mode", "user_prompt", "status", "split", F.when(F.col("status") == "ok", F.array_join("sub_json.checklist", "|")).alias("checklist"))


@query(f"{_TRAIN} SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE level = 'short') AS n_short, count(*) FILTER (WHERE level = 'medium') AS n_medium, count(*) FILTER (WHERE level = 'long') AS n_long, count(DISTINCT id) AS n_images FROM training WHERE status = 'ok' GROUP BY split")
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_report(_training(spark, sf_dir).where("status = 'ok'"))


@query("SELECT conv_id, count(DISTINCT turn % 3) AS n_splits FROM conversations GROUP BY conv_id HAVING count(DISTINCT turn % 3) > 1")
def id_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split by turn leaks conversations."""
    return split.leaks(table(spark, sf_dir, "conversations").withColumn("split", F.col("turn") % 3), group="conv_id")


@query("SELECT c_custkey FROM customer ORDER BY md5('3407|' || c_custkey), c_custkey LIMIT 20")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.seeded_sample(table(spark, sf_dir, "customer"), "c_custkey", 20).select("c_custkey")


@query(f"{_TRAIN} SELECT coalesce(split, 'all') AS split, count(*) AS n_rows, sum(len(es))::BIGINT AS n_stripped, 0 AS n_remaining FROM training JOIN (SELECT id, es FROM caps) USING (id) WHERE status = 'ok' GROUP BY ROLLUP (split)")
def finalize_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.finalise_report(_training(spark, sf_dir).where("status = 'ok'"))


# --- coverage of file names

_PHRASE = "trim(regexp_replace(lower(strip_accents(translate({}, 'đĐ', 'dD'))), '[^a-z0-9]+', ' ', 'g'))"
_COVER = f"""WITH rows AS (SELECT p_partkey, 'train' || (p_partkey % 2) AS split, ['short', 'medium', 'long'][1 + p_partkey % 3] AS mode, p_type, p_name, p_brand,
  replace(p_name, ' ', '_') || '_' || lpad(p_partkey::VARCHAR, 6, '0') AS id, string_split(p_name, ' ') AS ws,
  ' ' || {_PHRASE.format("CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE upper(array_to_string(string_split(p_name, ' ')[1:(p_partkey % 3 + 1)], '-')) || ', ' || p_type END")} || ' ' AS said,
  ' ' || {_PHRASE.format("CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE p_name || '!' END")} || ' ' AS shown FROM part),
words AS (SELECT *, list_filter(ws, lambda w: w <> '') AS w FROM rows),
ks AS (SELECT *, list_reverse(range(least(2, len(w)), len(w) + 1)) AS ks, length(array_to_string(ws, '_')) >= 30 AS cut FROM words),
found AS (SELECT *, list_filter(ks, lambda k: contains(said, ' ' || array_to_string(w[1:k], ' ') || CASE WHEN cut AND k = len(w) THEN '' ELSE ' ' END))[1] AS a, list_filter(ks, lambda k: contains(shown, ' ' || array_to_string(w[1:k], ' ') || CASE WHEN cut AND k = len(w) THEN '' ELSE ' ' END))[1] AS b FROM ks),
classed AS (SELECT *, CASE WHEN b IS NOT NULL THEN CASE WHEN coalesce(a >= b, false) THEN 'co_trong_prompt' ELSE 'thieu__target_co' END WHEN a IS NOT NULL THEN 'co_trong_prompt' ELSE 'thieu__target_khong_co' END AS category, array_to_string(w[1:coalesce(b, len(w))], ' ') AS term, array_to_string(ws, '_') AS slug FROM found)"""


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts named by their slug; prompts and targets that have all, some or none of it."""
    n, name = F.col("p_partkey"), F.col("p_name")
    said = F.when(n % 5 == 0, F.col("p_type")).otherwise(F.concat(F.upper(F.array_join(F.slice(F.split(name, " "), F.lit(1), (n % 3 + 1).cast("int")), "-")), F.lit(", "), "p_type"))
    shown = F.when(n % 4 == 0, F.col("p_type")).otherwise(F.concat(name, F.lit("!")))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("train"), (n % 2).cast("string")).alias("split"), F.get(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), (n % 3).cast("int")).alias("mode"), "p_brand", F.concat_ws("_", F.replace(name, F.lit(" "), F.lit("_")), F.lpad(n.cast("string"), 6, "0")).alias("id"), said.alias("said"), shown.alias("shown"))
    return rows.withColumn("x", coverage.classify(F.col("id"), F.col("said"), F.col("shown"))).select("*", "x.*").drop("x")


@query(f"{_COVER} SELECT p_partkey, category, term FROM classed")
def term_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("p_partkey", "category", "term")


@query(f"{_COVER} SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE split END AS split, CASE WHEN grouping(mode) = 1 THEN 'all' ELSE mode END AS mode, count(*) AS n, count(*) FILTER (WHERE category = 'co_trong_prompt') AS co_trong_prompt, count(*) FILTER (WHERE category = 'thieu__target_co') AS thieu__target_co, count(*) FILTER (WHERE category = 'thieu__target_khong_co') AS thieu__target_khong_co FROM classed GROUP BY CUBE (split, mode)")
def term_coverage_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.cube(classified(spark, sf_dir))


@query(f"{_COVER} SELECT slug, count(*) AS n, count(*) FILTER (WHERE category <> 'co_trong_prompt') AS n_missing, round(count(*) FILTER (WHERE category <> 'co_trong_prompt') / count(*), 4) AS miss_ratio FROM classed GROUP BY slug HAVING n_missing > 0 ORDER BY miss_ratio DESC, n DESC, slug LIMIT 20")
def topic_miss_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.worst_topics(classified(spark, sf_dir))


@query(f"{_COVER} SELECT category, p_brand AS language, count(*) AS n FROM classed WHERE category <> 'co_trong_prompt' GROUP BY ALL")
def missing_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.by_language(classified(spark, sf_dir).withColumnRenamed("p_brand", "language"))


@query(f"{_COVER} SELECT category, count(DISTINCT id) AS n_images FROM classed WHERE category <> 'co_trong_prompt' GROUP BY category")
def images_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.images_missing(classified(spark, sf_dir))


@query("SELECT o_orderkey, trim(regexp_replace(string_split(r, ':')[1], '\\s*\\d+\\s+', ' ', 'g')) AS label FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'missing ' || o_orderkey || ' core facts: x 3 y' WHEN 1 THEN 'adds 12 facts' ELSE o_orderstatus || ' 7 lost' END AS r FROM orders)")
def reason_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    reason = F.when(n % 3 == 0, F.concat(F.lit("missing "), n.cast("string"), F.lit(" core facts: x 3 y"))).when(n % 3 == 1, "adds 12 facts").otherwise(F.concat("o_orderstatus", F.lit(" 7 lost")))
    return table(spark, sf_dir, "orders").select("o_orderkey", reason_label(reason).alias("label"))


def prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts(spark, sf_dir)
