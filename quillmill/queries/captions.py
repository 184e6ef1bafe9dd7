"""Queries on captions, facts and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import jsonx, stats, text
from ..functions.plan import once
from ..operators import audit, caption, facts
from ..plans import curation
from ..sources.topics import with_hint
from .adapters import CAPS, at_rank, captions, fact_texts, head_noun, later_facts, joined, nearest, wc, ws
from .registry import query, table


def cap() -> F.Column:
    return F.col("caption")


def semi(x) -> F.Column:
    return F.array_join(x, "; ")


@query(f"WITH {CAPS} SELECT id, len(es) AS n_elements, len(list_filter(es, lambda e: e.type = 'text')) AS n_text_elements, {wc('high')} AS words_high_level, {wc('ground')} AS words_background, coalesce(list_sum(list_transform(es, lambda e: {wc('e.desc')})), 0)::BIGINT AS words_desc_total FROM caps")
def doc_word_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions(spark, sf_dir).select("id", *caption.measures(cap()))


_ERRORS = """list_concat(list_filter([
    CASE WHEN photo IS NOT NULL AND art_style IS NOT NULL THEN 'both photo and art_style' WHEN photo IS NULL AND art_style IS NULL THEN 'neither photo nor art_style' END,
    CASE WHEN {ground} THEN 'no background' END,
    CASE WHEN len(es) = 0 THEN 'elements is empty or no list' END], lambda x: x IS NOT NULL),
  flatten(list_transform(es, lambda e, i: list_filter([
    CASE WHEN e.type NOT IN ('obj', 'text') THEN 'elements[' || (i - 1) || ']: type is neither obj nor text' END,
    CASE WHEN e.type = 'text' AND coalesce(e.text, '') = '' THEN 'elements[' || (i - 1) || ']: a text element has no text' END,
    CASE WHEN e.desc = '' THEN 'elements[' || (i - 1) || ']: no desc' END], lambda x: x IS NOT NULL))))"""
ERRORS = _ERRORS.format(ground="coalesce(ground, '') = ''")
STANDALONE_ERRORS = _ERRORS.format(ground="ground IS NULL")


def _fast(values: str) -> str:
    return f"list_sort({values})"


def _shape(name: str) -> str:
    return f"(SELECT {nearest('v', 0.5)} FROM {name})"


@query(f"""WITH {CAPS}, seen AS (SELECT *, len({ERRORS}) AS n_errors FROM caps), per_desc AS (SELECT {wc('d')} AS v FROM (SELECT unnest(list_transform(es, lambda e: e.desc)) AS d FROM caps)), per_file AS (SELECT len(es) AS v FROM caps), per_ground AS (SELECT {wc('ground')} AS v FROM caps), per_high AS (SELECT {wc('high')} AS v FROM caps)
SELECT count(*) AS n_files_input, count(*) FILTER (WHERE n_errors = 0) AS n_files_ok, count(*) FILTER (WHERE n_errors > 0) AS n_files_schema_error, sum(len(es))::BIGINT AS total_elements, sum(len(list_filter(es, lambda e: e.type = 'text')))::BIGINT AS text_elements,
  round(sum(len(list_filter(es, lambda e: e.type = 'text'))) / sum(len(es)), 5) AS text_element_ratio, {_shape('per_file')} AS median_elements, {_shape('per_desc')} AS median_words_per_desc,
  (SELECT {nearest('v', 0.9)} FROM per_ground) AS p90_words_background, (SELECT {nearest('v', 0.99)} FROM per_high) AS p99_words_high_level, (SELECT round(avg(v), 2) FROM per_desc) AS mean_words_per_desc
FROM seen""")
def audit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captions(spark, sf_dir).withColumn("errors", caption.validate(cap()))
    out, of = audit.roll_up(rows), lambda name: F.try_element_at("distributions", F.lit(name))
    return out.select("*", of("words_background")["p90"].alias("p90_words_background"), of("words_high_level")["p99"].alias("p99_words_high_level"), of("words_per_desc")["mean"].alias("mean_words_per_desc")).drop("distributions")


@query(f"SELECT lang, min(v) AS min, {nearest('v', 0.25)} AS p25, {nearest('v', 0.5)} AS p50, {nearest('v', 0.75)} AS p75, {nearest('v', 0.9)} AS p90, {nearest('v', 0.99)} AS p99, max(v) AS max, round(avg(v), 2) AS mean FROM (SELECT lang, {wc('text')} AS v FROM documents) GROUP BY lang")
def percentiles_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.percentiles(table(spark, sf_dir, "documents"), text.word_count(F.col("text")), ["lang"])


@query(f"SELECT source, count(v) AS n, round(avg(v), 2) AS mean, {at_rank('v', 'count(v) // 2')} AS median, min(v) AS min, max(v) AS max FROM (SELECT source, {wc('text')} AS v FROM documents) GROUP BY source")
def upper_median_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_summary(table(spark, sf_dir, "documents"), text.word_count(F.col("text")), ["source"])


@query(f"WITH {CAPS} SELECT id, high, coalesce(array_to_string(list_transform(es, lambda e, i: (i - 1) || '~' || e.type || '~' || coalesce(e.text, '') || '~' || e.desc), '|'), '') AS elements FROM caps")
def caption_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From JSON text, with keys that are dropped and keys out of order, to a caption with numbered elements."""
    raw = F.to_json(F.struct(F.lit(1).alias("bbox"), cap()["compositional_deconstruction"].alias("compositional_deconstruction"), cap()["style_description"].alias("style_description"), cap()["high_level_description"].alias("high_level_description")))
    rows = captions(spark, sf_dir).select("id", caption.with_ids(caption.parse(raw)).alias("c"))
    line = F.transform(F.col("c.compositional_deconstruction.elements"), lambda e: F.concat_ws("~", e["id"].cast("string"), e["type"], F.coalesce(e["text"], F.lit("")), e["desc"]))
    return rows.select("id", F.col("c.high_level_description").alias("high"), F.array_join(line, "|").alias("elements"))


@query(f"WITH {CAPS} SELECT id, len(errors) AS n_errors, array_to_string(errors, '; ') AS errors FROM (SELECT id, {ERRORS} AS errors FROM caps)")
def caption_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captions(spark, sf_dir).select("id", caption.validate(cap()).alias("errors"))
    return rows.select("id", F.size("errors").alias("n_errors"), semi("errors").alias("errors"))


@query(f"WITH {CAPS} SELECT id, len(errors) AS n_errors, array_to_string(errors, '; ') AS errors FROM (SELECT id, {STANDALONE_ERRORS} AS errors FROM caps)")
def caption_validate_standalone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From JSON text, presence told by its keys."""
    rows = captions(spark, sf_dir).select("id", caption.validate_text(F.to_json(cap()), "standalone").alias("errors"))
    return rows.select("id", F.size("errors").alias("n_errors"), semi("errors").alias("errors"))


@query(f"WITH {CAPS} SELECT id, lang FROM caps WHERE len({ERRORS}) = 0")
def strict_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caption.keep_valid(captions(spark, sf_dir).withColumn("errors", caption.validate(cap()))).select("id", "lang")


def _json(x: str) -> str:
    return f"to_json({x})::VARCHAR"


def _fields(*pairs: tuple[str, str]) -> str:
    return "'{' || array_to_string(list_filter([" + ", ".join(f"CASE WHEN {x} IS NOT NULL THEN '\"{n}\":' || {v} END" for n, x, v in ((n, x, _json(x)) for n, x in pairs)) + "], lambda f: f IS NOT NULL), ',') || '}'"


_STYLE = _fields(("aesthetics", "aesthetics"), ("lighting", "lighting"), ("photo", "photo"), ("medium", "medium"), ("art_style", "art_style"))
_ELEMENT = _fields(("type", "e.type"), ("text", "e.text"), ("desc", "e.desc"))
LABEL = f"'{{\"high_level_description\":' || {_json('high')} || ',\"style_description\":' || {_STYLE} || ',\"compositional_deconstruction\":{{' || CASE WHEN ground IS NOT NULL THEN '\"background\":' || {_json('ground')} || ',' ELSE '' END || '\"elements\":[' || coalesce(array_to_string(list_transform(es, lambda e: {_ELEMENT}), ','), '') || ']}}}}'"


@query(f"WITH {CAPS} SELECT id, {LABEL} AS label, md5({LABEL}) AS fingerprint FROM caps")
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: numbers put on elements and taken off again, minified, in order, without nulls."""
    rows = captions(spark, sf_dir).select("id", caption.label_text(caption.without_ids(caption.with_ids(cap()))).alias("label"))
    return rows.select("id", "label", F.md5(F.col("label").cast("binary")).alias("fingerprint"))


@query(f"WITH {CAPS} SELECT id, lang || '_' || source AS slug, lang || ' ' || source AS ten_thu_muc, r.r_name AS thuat_ngu FROM caps LEFT JOIN (SELECT r_regionkey, r_name FROM region) r ON caps.source = 'src' || r.r_regionkey")
def topic_slug_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region table as topics: those of which there is a source in the dimension get a term."""
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("src"), "r_regionkey").alias("source"), F.col("r_name").alias("thuat_ngu"), F.array("r_name").alias("dong_nghia"))
    langs = captions(spark, sf_dir).select("lang").distinct()
    topics = regions.join(langs).select(F.concat_ws("_", "lang", "source").alias("slug"), "thuat_ngu", "dong_nghia")
    rows = with_hint(captions(spark, sf_dir).select("id"), topics)
    return rows.select("id", text.topic_slug(F.col("id")).alias("slug"), "goi_y_chu_de.ten_thu_muc", "goi_y_chu_de.thuat_ngu")


@query("""WITH items AS (SELECT o_custkey, list({'rank': CASE WHEN o_orderkey % 3 = 0 THEN 99 ELSE o_orderkey % 5 END, 'at': o_orderkey, 'text': o_orderpriority, 'kind': CASE WHEN o_orderstatus = 'F' THEN 'color' ELSE 'attribute' END}) AS xs FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
SELECT o_custkey, array_to_string(list_transform(list_sort(xs), lambda x, i: (i - 1) || ':' || x.kind || ':' || x.text), '|') AS facts FROM items""")
def clean_ranked_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as ranked facts: blank texts, missing ranks, strange kinds and ties."""
    n = F.col("o_orderkey")
    line = F.struct(n, F.when(n % 3 != 0, n % 5).cast("int").alias("rank"), F.when(F.col("o_orderstatus") == "F", "color").otherwise("hue").alias("kind"), F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("text"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(line)).alias("xs"))
    items = F.transform("xs", lambda x: F.struct(x["rank"].alias("rank"), x["kind"].alias("kind"), x["text"].alias("text"))).cast(f"array<{schemas.FACT}>")
    out = rows.select("o_custkey", F.array_join(F.transform(facts.clean_ranked(items), lambda f: F.concat_ws(":", f["rank"].cast("string"), f["kind"], f["text"])), "|").alias("facts"))
    return out.where("facts <> ''")


@query(f"WITH {CAPS} SELECT id, len(es) AS n_elements, coalesce(array_to_string(list_filter(list_transform(es, lambda e, i: CASE WHEN i % 3 <> 1 THEN (i - 1)::VARCHAR END), lambda x: x IS NOT NULL), ','), '') AS orphans FROM caps")
def orphan_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that no group has, where the groups have every third."""
    rows = curation.numbered(captions(spark, sf_dir).select("id", "caption"))
    ids = F.transform(caption.elements(cap()), lambda e: e["id"])
    one = lambda i: F.array(F.struct(F.lit(0).alias("rank"), F.lit("subject").alias("kind"), F.concat(F.lit("e"), i.cast("string")).alias("text")))
    group = F.struct(F.lit("third").alias("name"), F.filter(ids, lambda i: i % 3 == 0).alias("member_ids"), F.lit("vague").alias("cardinality"), F.lit(False).alias("cultural"))
    none = F.array().cast("array<int>")
    d = F.struct(none.alias("chu_de_chinh"), F.lit(False).alias("khop_goi_y"), F.array(group).alias("concept_groups"), F.map_from_arrays(F.transform(ids, lambda i: i.cast("string")), F.transform(ids, one)).alias("facts"), none.alias("background_facts"), F.create_map().alias("style_facts"))
    kinds = {"chu_de_chinh": f"array<{schemas.THEME_FACT}>", "background_facts": f"array<{schemas.FACT}>", "style_facts": f"map<string, array<{schemas.THEME_FACT}>>"}
    for name, kind in kinds.items():
        d = d.withField(name, F.lit(None).cast(kind))
    rows = once(once(rows, d=d), groups=facts.selection_input(cap(), F.col("d"))["groups"])
    alone = F.transform(F.filter("groups", lambda g: g["name"] != "third"), lambda g: F.substring(g["name"], 2, 9))
    return rows.select("id", F.size(ids).alias("n_elements"), F.array_join(alone, ",").alias("orphans"))


@query("""WITH named AS (SELECT o_custkey, list(o_orderpriority ORDER BY o_orderkey) AS names FROM orders GROUP BY o_custkey)
SELECT o_custkey, array_to_string(list_transform(names, lambda x, i: CASE WHEN len(list_filter(names[1:i], lambda y: y = x)) > 1 THEN x || ' [' || len(list_filter(names[1:i], lambda y: y = x)) || ']' ELSE x END), '|') AS names FROM named""")
def duplicate_group_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as groups named by priority."""
    named = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("xs"))
    return named.select("o_custkey", F.array_join(facts.numbered_names(F.transform("xs", lambda x: x["o_orderpriority"])), "|").alias("names"))


@query("""SELECT o_orderkey, card, n, CASE WHEN n >= 2 THEN 'số lượng: ' || n END AS count_fact, card = 'vague' OR coalesce(n >= 2, false) AS plural
FROM (SELECT o_orderkey, card, TRY_CAST(CASE WHEN card LIKE 'exact:%' THEN card[7:] END AS INT) AS n FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'vague' WHEN 1 THEN 'exact:' || (o_orderkey % 7) WHEN 2 THEN 'exact:abc' ELSE 'exact:1' END AS card FROM orders))""")
def cardinality_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    card = F.when(k % 4 == 0, "vague").when(k % 4 == 1, F.concat(F.lit("exact:"), (k % 7).cast("string"))).when(k % 4 == 2, "exact:abc").otherwise("exact:1")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", card.alias("card"))
    c = F.col("card")
    return rows.select("o_orderkey", "card", text.exact_count(c).alias("n"), text.count_fact(c).alias("count_fact"), text.is_plural(c).alias("plural"))


@query("SELECT doc_id, trim(regexp_replace(lower(strip_accents(translate(text, 'đĐ', 'dD'))), '[^a-z0-9]+', ' ', 'g')) AS phrase FROM documents")
def phrase_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.phrase_form(F.col("text")).alias("phrase"))


@query(f"""WITH q AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '"' || t || '"' WHEN 1 THEN '“' || t || '”' WHEN 2 THEN '“' || t || '“' ELSE t END AS s FROM (SELECT doc_id, {joined(ws("text"))} AS t FROM documents)),
a AS (SELECT doc_id, CASE WHEN length(s) >= 2 AND left(s, 1) = right(s, 1) AND left(s, 1) IN ('"', '''', '“') THEN trim(s[2:-2]) ELSE s END AS s FROM q)
SELECT doc_id, CASE WHEN starts_with(s, '“') AND ends_with(s, '”') THEN trim(s[2:-2]) ELSE s END AS prompt FROM a""")
def clean_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id") % 4
    quoted = F.when(n == 0, F.concat(F.lit('"'), "text", F.lit('"'))).when(n == 1, F.concat(F.lit("“ "), "text", F.lit(" ”"))).when(n == 2, F.concat(F.lit("“"), "text", F.lit("“"))).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "documents")
    # A quoted text's own white space at its ends goes with the quotes.
    return rows.select("doc_id", text.unquoted(quoted).alias("prompt"))


@query(f"WITH {CAPS} SELECT id, {head_noun('high')} AS theme, len(es) AS n_elements, coalesce(array_to_string(flatten(list_transform(es, lambda e: {fact_texts('e.desc')})), '|'), '') AS facts FROM caps")
def mock_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by rules, cleaned, of all elements in order."""
    d = curation.decomposed(curation.numbered(captions(spark, sf_dir))).withColumnRenamed("decomposition", "d")
    ids = F.transform(caption.elements(cap()), lambda e: e["id"].cast("string"))
    every = F.flatten(F.transform(ids, lambda i: facts.texts(F.try_element_at("d.facts", i))))
    return d.select("id", F.col("d.chu_de_chinh")[0]["text"].alias("theme"), F.size(caption.elements(cap())).alias("n_elements"), F.array_join(every, "|").alias("facts"))


def _blank(x: str) -> str:
    return f"len(list_filter({later_facts(x)}[1:7], lambda t: trim(t) = '')) > 0"


@query(f"""WITH {CAPS} SELECT id, CASE WHEN len(es) = 0 THEN 'facts is empty' ELSE array_to_string(list_concat(list_concat(
  CASE WHEN doc_id % 3 = 0 THEN ['chu_de_chinh is empty'] ELSE [] END,
  list_concat(CASE WHEN doc_id % 5 = 0 THEN ['concept_groups[0] has no valid cardinality'] ELSE [] END, CASE WHEN doc_id % 7 = 0 THEN ['concept_groups[0] has unknown members 9999'] ELSE [] END)), list_concat(
  flatten(list_transform(es, lambda e, i: CASE WHEN {_blank('e.desc')} THEN ['facts.' || (i - 1) || ' has a fact without text'] ELSE []::VARCHAR[] END)),
  CASE WHEN trim(coalesce(ground, '')) <> '' AND {_blank('ground')} THEN ['background_facts has a fact without text'] ELSE [] END)), '; ') END AS errors
FROM caps""")
def decomposition_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decompositions by rules with faults put in; captions without elements have no facts, and parts that are marks alone leave facts without text."""
    rows = curation.numbered(captions(spark, sf_dir).select("doc_id", "id", "caption"))
    rows = once(once(rows, signs=facts.element_signs(cap())), d=facts.rule_decomposition(cap(), F.col("signs")))
    n, g = F.col("doc_id"), F.col("d.concept_groups")
    first = g[0].withField("cardinality", F.when(n % 5 == 0, "some").otherwise(g[0]["cardinality"])).withField("member_ids", F.when(n % 7 == 0, F.concat(g[0]["member_ids"], F.array(F.lit(9999)))).otherwise(g[0]["member_ids"]))
    bad = F.col("d").withField("concept_groups", F.concat(F.array(first), F.slice(g, F.lit(2), F.size(g)))).withField("chu_de_chinh", F.when(n % 3 == 0, F.array().cast(f"array<{schemas.THEME_FACT}>")).otherwise(F.col("d.chu_de_chinh")))
    return once(rows, bad=bad).select("id", semi(facts.validate_decomposition(F.col("bad"), cap())).alias("errors"))


@query("SELECT page_id, CASE WHEN page_id % 5 IN (0, 1, 2) THEN '{\"id\":' || page_id || ',\"t\":[1,{\"x\":null}]}' END AS json, CASE page_id % 5 WHEN 3 THEN 'no braces' WHEN 4 THEN 'does not parse' END AS error FROM pages")
def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with thoughts, fences, words around, cut off or without JSON."""
    n = F.col("page_id")
    body = F.concat(F.lit('{"id":'), n.cast("string"), F.lit(',"t":[1,{"x":null}]}'))
    raw = (
        F.when(n % 5 == 0, F.concat(F.lit("<think>{a}</think>\n```json\n"), body, F.lit("\n```")))
        .when(n % 5 == 1, F.concat(F.lit("Here it is: "), body, F.lit(" as asked")))
        .when(n % 5 == 2, body)
        .when(n % 5 == 3, F.lit("none"))
        .otherwise(F.concat(F.substring(body, 1, 9), F.lit("[}")))
    )
    rows = table(spark, sf_dir, "pages").select("page_id", jsonx.extracted_object(raw).alias("x"))
    return rows.select("page_id", "x.json", "x.error")
