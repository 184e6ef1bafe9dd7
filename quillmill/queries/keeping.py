"""Queries on what is kept from run to run: keyed tables, streams, ordered sinks, guarded writes; and on JSON of any depth."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import walk
from ..functions.plan import once
from ..functions.text import word_count
from ..operators import audit, chat, persona, prediction, selection, split
from ..plans import curation, incremental, scorers
from ..plans.keyed import KeyedTable
from ..sources import files
from ..streaming import resume
from .adapters import CAPS, SELECTING, captions
from .registry import query, table
from .selecting import _LEVELS, evaluated

# --- keyed tables


@query("""WITH tries AS (SELECT o_orderkey, 1 AS attempt, o_orderkey % 4 AS n_levels FROM orders UNION ALL SELECT o_orderkey, 2, o_orderkey * 7 // 4 % 4 FROM orders WHERE o_orderkey % 4 < 3)
SELECT o_orderkey, max(n_levels * 10 + attempt) // 10 AS n_levels, max(n_levels * 10 + attempt) % 10 AS attempt, (SELECT count(*) FROM tries) AS n_merged FROM tries GROUP BY o_orderkey""")
def keyed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results by key, some asked again: a retry that did worse stays out, and a batch that is merged twice changes nothing."""
    n = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    first = orders.select(n, F.lit(1).alias("attempt"), (n % 4).alias("n_levels"))
    again = orders.where(n % 4 < 3).select(n, F.lit(2).alias("attempt"), (F.floor(n * 7 / 4) % 4).alias("n_levels"))
    kept = KeyedTable(spark, files.scratch(spark), ("o_orderkey",), ("n_levels", "attempt"), buckets=16)
    for batch, rows in ((0, first), (1, again), (1, again), (0, first)):
        kept.merge(rows, "retries", batch)
    kept.vacuum()
    return kept.read().withColumn("n_merged", F.lit(kept.state()["n_merged"]))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'input changed' WHEN o_orderkey % 5 = 0 THEN 'never asked' ELSE 'partial' END AS why FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0")
def keyed_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose kept result is missing, of another input, or partial."""
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(n, incremental.fingerprint(n, F.col("o_orderpriority")).alias("fingerprint"))
    kept = KeyedTable(spark, files.scratch(spark), ("o_orderkey",), buckets=16)
    kept.merge(rows.where((n % 5 != 0) | (n % 3 == 0)).select(n, F.when(n % 3 == 0, "old").otherwise(F.col("fingerprint")).alias("fingerprint"), F.when(n % 7 == 0, 1).otherwise(3).alias("n_levels")))
    left = incremental.todo(rows, kept.read(), ["o_orderkey"], retry=F.col("n_levels") < 3)
    why = F.when(n % 3 == 0, "input changed").when(n % 5 == 0, "never asked").otherwise("partial")
    return left.select("o_orderkey", why.alias("why"))


# --- streams


@query("""SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids, sum(value::DECIMAL(18, 2))::DOUBLE AS total, (SELECT count(*) FROM events) AS n_scored FROM events GROUP BY event_type""")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come as files in two runs with a restart between, a tenth of them delivered in both: the stream's state knows them again, and each is scored once."""
    events, folder, mark = table(spark, sf_dir, "events"), files.scratch(spark), files.scratch(spark)
    kept = KeyedTable(spark, files.scratch(spark), ("event_id",), buckets=8)
    schema = "event_id bigint, ts timestamp, event_type string, value double"
    step = lambda df: resume.fresh(df, ["event_id"], "ts", "90 days").withColumn("score", F.col("value").cast("decimal(18,2)"))
    late, again = F.col("event_id") % 2 == 1, F.col("event_id") % 10 == 0
    n = 0
    for part in (events.where(~late), events.where(late | again)):
        part.select("event_id", "ts", "event_type", "value").repartition(3).write.mode("append").parquet(folder)
        n += resume.run_available(spark, folder, schema, step, kept, mark, files=2)
    out = kept.read().groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"), F.sum("score").cast("double").alias("total"))
    return out.withColumn("n_scored", F.lit(n).cast("long"))


# --- sinks


@query("""SELECT r // 500 AS file, r % 500 AS place, key, (SELECT count(*) FROM orders WHERE o_orderkey % 5 <> 0) AS n_written FROM (
  SELECT o_orderkey || '__' || mode AS key, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS r FROM (SELECT *, ['short', 'medium', 'long'][1 + o_orderkey % 3] AS mode FROM orders) WHERE o_orderkey % 5 <> 0)""")
def ordered_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions in the order of the test rows, so many a file, read back by file and place; test rows without one are left out."""
    mode = F.get(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), (F.col("o_orderkey") % 3).cast("int"))
    tests = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), mode.alias("mode"), "o_orderdate")
    said = tests.where("id % 5 <> 0").select("id", "mode", F.format_string('{"k": %d}', "id").alias("pred_json"))
    folder = files.scratch(spark)
    manifest = prediction.write_in_order(prediction.merge(tests, said), folder, ["o_orderdate", "id"], per_file=500)
    rows = prediction.read_in_order(spark, folder, "key string, pred_json string")
    return rows.select("file", "place", "key").join(F.broadcast(manifest.agg(F.sum("n_rows").alias("n_written"))))


@query(f"WITH {CAPS} SELECT split, count(*) AS n, sum(n_e)::BIGINT AS n_elements, (SELECT sum(len(es))::BIGINT FROM caps) AS n_stripped FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN 'test' ELSE 'train' END AS split, len(es) AS n_e FROM caps) GROUP BY split")
def finalised_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels without the ids of their elements, written in the job that counts what was stripped and refuses them if one remained."""
    rows = curation.numbered(captions(spark, sf_dir).select("doc_id", "caption"))
    out, seen = split.finalised(rows.select(F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train").alias("split"), "caption"), "caption")
    counted = out.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.size("caption.compositional_deconstruction.elements")).alias("n_elements"))
    return counted.withColumn("n_stripped", F.lit(seen["stripped"]).cast("long"))


# --- JSON of any depth

_DOCS = f"""WITH {CAPS}, docs AS (SELECT id, to_json({{'high_level_description': high,
  'style_description': {{'aesthetics': aesthetics, 'lighting': lighting, 'photo': photo, 'medium': medium, 'art_style': art_style, 'color_palette': ['#fff', NULL]}},
  'compositional_deconstruction': {{'background': ground, 'elements': list_transform(es, lambda e, i: {{'type': e.type, 'text': e.text, 'desc': e.desc, 'bbox': [i, length(e.desc)]}})}}}}) AS doc FROM caps),
tree AS (SELECT docs.id, t.key, t.type, t.atom ->> '$' AS atom, replace(t.fullkey, '$.', '') AS place FROM docs, json_tree(docs.doc) AS t)"""


def boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, json): captions with boxes of their elements and a palette."""
    c = F.col("caption")
    boxes = F.transform(c["compositional_deconstruction"]["elements"], lambda e, i: F.struct(e["type"].alias("type"), e["text"].alias("text"), e["desc"].alias("desc"), F.array(i + 1, F.char_length(e["desc"])).alias("bbox")))
    whole = c.withField("compositional_deconstruction.elements", boxes).withField("style_description.color_palette", F.array(F.lit("#fff"), F.lit(None).cast("string")))
    return captions(spark, sf_dir).select("id", F.to_json(whole, {"ignoreNullFields": "false"}).alias("json"))


@query(f"{_DOCS} SELECT id, place AS path FROM tree WHERE type = 'NULL'")
def null_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of nulls at any depth."""
    return walk.walk(boxed(spark, sf_dir), "id", "json").null_paths()


@query(f"{_DOCS} SELECT DISTINCT id, key AS name FROM tree WHERE key IS NOT NULL AND NOT regexp_matches(place, '\\[[0-9]+\\]$')")
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys at any depth, once for each document."""
    return walk.walk(boxed(spark, sf_dir), "id", "json").keys()


@query(f"{_DOCS} SELECT id, count(*) AS n_leaves, md5(string_agg(place || '=' || coalesce(atom, '-'), '|' ORDER BY place)) AS digest FROM tree WHERE type NOT IN ('OBJECT', 'ARRAY') AND NOT contains(place, 'bbox') AND NOT contains(place, 'color_palette') GROUP BY id")
def stripped_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of documents without boxes and palettes, put together as text and taken apart again."""
    bare = walk.without_keys(boxed(spark, sf_dir), "id", "json")
    leaves = walk.walk(bare, "id", "json").leaves()
    said = F.concat("path", F.lit("="), F.coalesce("value", F.lit("-")))
    return leaves.groupBy("id").agg(F.count("*").alias("n_leaves"), F.md5(F.array_join(F.array_sort(F.collect_list(F.struct("path", said.alias("said"))))["said"], "|").cast("binary")).alias("digest"))


@query("""SELECT doc_id, sha1('{"doc_id":' || doc_id || ',"meta":{"lang":"' || lang || '","n":' || n_chars || ',"source":["' || source || '",{"a":1.5,"b":null}]}}') AS fingerprint, true AS same, false AS changed FROM documents""")
def canonical_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of inputs: the same whatever the order of keys at any depth and the zeros of a decimal, another where a value changed."""
    docs = table(spark, sf_dir, "documents")
    text = lambda form, *c: F.format_string(form, *c)
    one = text('{"meta": {"source": ["%s", {"b": null, "a": 1.50}], "n": %d, "lang": "%s"}, "doc_id": %d}', "source", "n_chars", "lang", "doc_id")
    two = text('{"doc_id":%d,"meta":{"lang":"%s","n":%d.0,"source":["%s",{"a":1.5,"b":null}]}}', "doc_id", "lang", "n_chars", "source")
    three = text('{"doc_id":%d,"meta":{"lang":"%s","n":%d,"source":["%s",{"a":1.5,"b":0}]}}', "doc_id", "lang", "n_chars", "source")
    stamp = lambda t: F.sha1(incremental.canonical(t).cast("binary"))
    return docs.select("doc_id", stamp(one).alias("fingerprint"), (stamp(one) == stamp(two)).alias("same"), (stamp(one) == stamp(three)).alias("changed"))


# --- prompts, answers and their repair


@query(f"""{SELECTING}, {_LEVELS} SELECT id, detail_level, len(c) AS n_facts, 2 AS n_written, 'checklist' AS judged, 2 AS n_judge FROM levels""")
def writer_and_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What writers and judges are asked: the specification with its persona, and the facts flat for a judge of rows without groups."""
    subs = selection.assemble(evaluated(spark, sf_dir))
    sub = F.struct(*(F.col(c) for c in subs.columns))
    asked = curation.write_messages(F.lit("Write."), persona.specification(sub, persona.persona(F.col("id"))))
    judge = curation.judge_messages(F.lit("Judge."), F.lit("show it"), F.lit(None).cast("struct<groups: array<string>>"), F.col("checklist"))
    rows = once(subs, w=asked, j=judge).select("id", "detail_level", F.size("checklist").alias("n_facts"), "w", "j")
    user = lambda m: F.get(F.col(m), F.lit(1))["content"]
    level = F.get_json_object(user("w"), "$.detail_level")
    keys = F.array_join(F.array_except(F.json_object_keys(user("j")), F.array(F.lit("user_prompt"))), ",")
    return rows.where((level == F.col("detail_level")) & F.get_json_object(user("w"), "$.persona").isNotNull()).select("id", "detail_level", "n_facts", F.size("w").alias("n_written"), keys.alias("judged"), F.size("j").alias("n_judge"))


@query(f"""{SELECTING}, {_LEVELS} SELECT detail_level, len(c) AS n_facts, count(*) AS n FROM levels GROUP BY ALL""")
def facts_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.facts_histogram(selection.assemble(evaluated(spark, sf_dir)))


@query("""WITH tried AS (SELECT o_orderkey AS id, unnest(range(1, 4)) AS attempt FROM orders), said AS (SELECT id, attempt, (id + attempt * 3) % 5 AS n FROM tried),
asked AS (SELECT *, coalesce(max((n = 4)::INT) OVER (PARTITION BY id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS open FROM said)
SELECT id, max(n * 10 + attempt) // 10 AS n_levels, max(n * 10 + attempt) % 10 AS attempt, count(*) AS n_calls, CASE WHEN max(n) < 4 THEN 'errors remain' END AS why FROM asked WHERE open GROUP BY id""")
def best_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers asked again until they are whole, three times at most: of those that never are, the best partial one stays. What a row is asked carries its calls, so their number shows."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), chat.messages(F.lit("s"), F.col("o_orderkey").cast("string")).alias("messages"))

    def make():
        return lambda messages: "x" * ((int(messages[1]["content"]) + (sum(m["role"] == "assistant" for m in messages) + 1) * 3) % 5)

    worth = lambda raw: F.char_length(raw)
    check = lambda raw: F.when(worth(raw) < 4, F.array(F.lit("partial"))).otherwise(F.array().cast("array<string>"))
    kept = KeyedTable(spark, files.scratch(spark), ("id",), ("attempt",), buckets=8)
    done = scorers.repaired(rows, make, "id", check, chat.repair_message, kept=kept, worth=worth, workers=2)
    last = kept.read().select("id", F.col("attempt").alias("n_calls"))
    return done.join(last, "id").select("id", worth(F.col("raw_output")).cast("long").alias("n_levels"), F.col("attempt").cast("long").alias("attempt"), F.col("n_calls").cast("long").alias("n_calls"), "why.message").withColumnRenamed("message", "why")


@query()
def token_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of turns as a tokenizer's ids: how many are masked and learned, and their checksum. A test holds it against a plain loop."""
    pairs = chat.pair_turns(table(spark, sf_dir, "conversations"))
    rows = pairs.select("conv_id", "turn", F.col("user").alias("user_prompt"), F.coalesce("system", F.lit("default")).alias("system"), F.col("answer").alias("target"))
    out = chat.encode_rows(rows, chat.token_ids(tokenizer_path("word_bpe_49k.json")))
    masked = F.size(F.filter("labels", lambda x: x == chat.IGNORED))
    return out.select("conv_id", "turn", "error", masked.alias("n_masked"), (F.col("n_tokens") - masked).alias("n_learned"), F.crc32(F.array_join("input_ids", " ").cast("binary")).alias("ids_crc"), word_count(F.col("target")).alias("n_words"))
