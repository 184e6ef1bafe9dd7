"""Queries on sources, sinks, caches, encodings, corrections and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx, text
from ..operators import chat, gate, persona, prediction, selection
from ..plans import curation, incremental, scorers
from ..sources import chat_http, files, topics
from .adapters import GATE, SELECTING, wc
from .chatting import _PAIRS
from .gating import decided
from .registry import query, table
from .selecting import _LEVELS, evaluated

# --- files


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey % 5 <> 4")
def document_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a JSON document a file, some of them no objects, read whole and parsed."""
    rows = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 5 == 4, F.lit("[1]")).otherwise(F.to_json(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("value"))
    folder = files.scratch(spark)
    rows.write.option("maxRecordsPerFile", 1).text(folder)
    good, _ = files.parsed(files.documents(spark, folder))
    return good.select(F.from_json("text", "n_nationkey bigint, n_name string, n_regionkey bigint").alias("x")).select("x.*")


@query("SELECT 'parse' AS kind, count(*) AS n, min(strlen('no object: [' || n_nationkey || ']' || chr(10)))::INT AS shortest FROM nation WHERE n_nationkey % 5 = 4")
def document_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What could not be read, through the error log: written over the old one, read back."""
    rows = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 5 == 4, F.format_string("[%d]", "n_nationkey")).otherwise(F.to_json(F.struct("n_name"))).alias("value"))
    folder, log = files.scratch(spark), files.scratch(spark)
    rows.write.option("maxRecordsPerFile", 1).text(folder)
    files.write_errors(spark.createDataFrame([("old", "parse", "stale")], "id string, kind string, message string"), log)
    files.write_errors(files.parsed(files.documents(spark, folder))[1], log)
    return files.read_jsonl(spark, log, "id string, kind string, message string").groupBy("kind").agg(F.count("*").alias("n"), F.min(F.char_length("message")).alias("shortest"))


@query("SELECT o_orderkey, o_orderpriority, o_orderkey % 7 AS part, (SELECT count(*) FROM orders) AS n_written FROM orders")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to JSON lines, counted while they are written, and read back strictly."""
    folder = files.scratch(spark)
    n = files.write_jsonl(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") % 7).alias("part")), folder)
    return files.read_jsonl(spark, folder, "o_orderkey bigint, o_orderpriority string, part bigint").withColumn("n_written", F.lit(n))


@query("SELECT count(*) FILTER (WHERE s_suppkey % 3 <> 0) AS n_read, count(*) FILTER (WHERE s_suppkey % 3 = 0) AS n_corrupt FROM supplier")
def jsonl_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = files.scratch(spark)
    table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 3 == 0, F.lit('{"s_suppkey": ')).otherwise(F.to_json(F.struct("s_suppkey"))).alias("value")).write.text(folder)
    read = files.read_jsonl_lenient(spark, folder, "s_suppkey bigint").cache()
    return read.agg(F.count_if(F.col("_corrupt_record").isNull()).alias("n_read"), F.count_if(F.col("_corrupt_record").isNotNull()).alias("n_corrupt"))


@query("SELECT 1 + (SELECT count(*) FROM region) AS line_no, '{\"r\": ' AS text")
def jsonl_bad_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a file that does not parse, by number."""
    folder = files.scratch(spark)
    good = table(spark, sf_dir, "region").select(F.to_json(F.struct("r_name")).alias("value"), F.lit(0).alias("o"))
    wrong = spark.createDataFrame([('{"r": ', 1), ("{}", 2), ("{", 3)], "value string, o int")
    good.unionByName(wrong).coalesce(1).sortWithinPartitions("o").select("value").write.text(folder)
    return files.bad_lines(spark, folder).select("line_no", "text")


@query("""SELECT p_partkey, '{"b":' || p_size || ',"a":null}' AS target FROM part""")
def jsonl_raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field kept as text, so that the order of its keys and its nulls survive."""
    folder = files.scratch(spark)
    table(spark, sf_dir, "part").select(F.format_string('{"p_partkey": %d, "target": {"b": %d, "a": null}}', "p_partkey", "p_size").alias("value")).write.text(folder)
    return files.read_jsonl_rows(spark, folder, ["target"], "p_partkey bigint")


@query("SELECT 'train' || (c_custkey % 3) AS split, count(*) AS n FROM customer GROUP BY 1")
def split_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each split, found again as the first that holds one."""
    folder = files.scratch(spark)
    files.write_split(table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("train"), (F.col("c_custkey") % 3).cast("string")).alias("split")), folder)
    found = files.first_split_folder(spark, None, [f"{folder}-none", folder], ("train0",))
    return spark.read.json(found).groupBy("split").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, round(sum(ps)::DOUBLE, 2) AS total FROM (SELECT l_quantity AS ps FROM lineitem)")
def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of one row as pretty JSON beside the data, read back as one document."""
    folder = files.scratch(spark)
    files.write_report(table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity").cast("double"), 2).alias("total")), folder)
    return files.read_json(spark, folder).select(F.col("n").cast("long").alias("n"), F.col("total").cast("double").alias("total"))


@query("SELECT n_nationkey, replace(lower(n_name), ' ', '_') || '_' || n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS thuat_ngu, replace(lower(n_name), '_', ' ') AS ten FROM nation")
def topic_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from a JSON file, those without a slug left out, joined by a row's slug; a file that is not there gives none."""
    folder = files.scratch(spark)
    slug = F.replace(F.lower("n_name"), F.lit(" "), F.lit("_"))
    nations = table(spark, sf_dir, "nation")
    entry = F.struct(F.when(F.col("n_nationkey") % 2 == 0, slug).alias("slug"), F.col("n_name").alias("thuat_ngu"), F.array("n_name").alias("dong_nghia"))
    nations.agg(F.collect_list(entry).alias("topics")).select(F.to_json(F.struct("topics")).alias("value")).write.text(folder)
    known = topics.topics(spark, folder).unionByName(topics.topics(spark, f"{folder}-none"))
    rows = nations.select("n_nationkey", F.concat_ws("_", slug, F.col("n_nationkey").cast("string")).alias("id"))
    return topics.with_hint(rows, known).select("n_nationkey", "id", "goi_y_chu_de.thuat_ngu", F.col("goi_y_chu_de.ten_thu_muc").alias("ten"))


_PROMPT = "(SELECT upper(left(c_mktsegment, 1)) || lower(c_mktsegment[2:]) || '.' FROM customer WHERE c_custkey = 1)"


@query(f"SELECT c_custkey, level, CASE WHEN level = 'short' THEN {_PROMPT} ELSE 'All.' END AS system, CASE WHEN level = 'short' THEN 'file' ELSE 'default' END AS origin, level = 'short' AND {_PROMPT} <> 'Few.' AS drifted FROM (SELECT c_custkey, ['short', 'long'][1 + c_custkey % 2] AS level FROM customer)")
def prompt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's prompt by level: from a folder, where one is written from the table, the default where it has none, and whether it drifted from the default."""
    folder, customers = files.scratch(spark), table(spark, sf_dir, "customer")
    customers.where("c_custkey = 1").select(F.concat(F.initcap("c_mktsegment"), F.lit("."))).coalesce(1).write.text(folder)
    held = spark.read.text(folder).inputFiles()[0].rpartition("/")[2].removesuffix(".txt")
    defaults = {held: "Few.", "long": "All."}
    read = topics.system_prompts(spark, folder, defaults)
    gone = chat.drifted(read, spark.createDataFrame(list(defaults.items()), "level string, system string")).select("level", F.lit(True).alias("d"))
    prompts = read.join(gone, "level", "left").select("level", F.trim(F.regexp_replace("system", "\\n", "")).alias("system"), "origin", F.coalesce("d", F.lit(False)).alias("drifted"))
    rows = customers.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, held).otherwise("long").alias("level"))
    return chat.with_system(rows, prompts, "level").join(F.broadcast(prompts.drop("system")), "level").select("c_custkey", F.when(F.col("level") == held, "short").otherwise("long").alias("level"), "system", "origin", "drifted")


# --- caches


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'short,medium,long' WHEN o_orderkey % 3 = 1 THEN 'short,long' ELSE 'medium' END AS levels FROM orders")
def cached_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable levels of cached entries, in order; old entries that noted none have all."""
    n = F.col("o_orderkey")
    held = F.when(n % 3 == 1, F.array(F.lit("long"), F.lit("short"))).when(n % 3 == 2, F.array(F.lit("medium"), F.lit("strange")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(incremental.usable_levels(held), ",").alias("levels"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 3 OR o_orderkey % 4 = 1")
def retried_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a current result, and those whose result has under three levels, which are asked again."""
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", incremental.fingerprint(n).alias("fingerprint"))
    cache = rows.where(n % 4 != 3).withColumn("levels", F.when(n % 4 == 1, F.array(F.lit("short"))).otherwise(F.array(F.lit("short"), F.lit("medium"), F.lit("long"))))
    return incremental.todo(rows, cache, ["o_orderkey"], retry=F.size("levels") < 3).select("o_orderkey")


@query("SELECT o_custkey, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS n_current FROM orders GROUP BY o_custkey HAVING n_current > 0")
def current_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", incremental.fingerprint(F.col("o_orderkey")).alias("fingerprint"))
    cache = rows.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("fingerprint")).otherwise("old").alias("fingerprint"), F.lit(1).alias("result"))
    return incremental.current(rows, cache, ["o_orderkey"]).groupBy("o_custkey").agg(F.count("*").alias("n_current"))


@query("SELECT o_custkey, max(o_orderkey % 5 * 10000000 + o_orderkey) % 10000000 AS o_orderkey, max(o_orderkey % 5) AS n_levels FROM orders GROUP BY o_custkey")
def newest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A retry that did worse does not replace what it retried."""
    cache = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 5).alias("n_levels"))
    return incremental.newest(cache, ["o_custkey"], [F.col("n_levels"), F.col("o_orderkey")])


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)")
def remaining_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select("c_custkey")
    return incremental.failures_left(failed, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 10 <> 0) AS n_matched, (SELECT count(*) FROM orders WHERE o_custkey % 10 = 0) AS n_unmatched, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 10 <> 0) AS n_common, (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer ORDER BY md5('3407|' || c_custkey), c_custkey LIMIT 20)) AS n_sampled")
def matched_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their targets and how many have none; keys that both have; rows of sampled keys."""
    from ..operators import split

    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    others = customers.where("id % 10 <> 0").withColumn("target", F.lit(1))
    joined, none = incremental.matched(rows, others)
    n = lambda df, name: df.agg(F.count("*").alias(name))
    sampled = incremental.restricted(rows, split.seeded_sample(customers, "id", 20))
    return n(joined, "n_matched").withColumn("n_unmatched", F.lit(none).cast("long")).join(n(incremental.common(rows, others), "n_common")).join(n(sampled, "n_sampled"))


# --- encoding

_TEMPLATE = f"""{_PAIRS}, enc AS (SELECT conv_id, turn, CASE WHEN conv_id % 10 = 3 OR trim(usr) = '' THEN 'empty prompt' WHEN conv_id % 10 = 0 THEN 'not JSON' END AS error,
  5 + {wc("coalesce(system, 'default')")} + {wc('usr')} AS n_masked, {wc('answer')} AS n_learned FROM pairs)"""


def encoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs as training rows: some prompts blank, some targets bad; a tokenizer of words to their lengths."""
    pairs = chat.pair_turns(table(spark, sf_dir, "conversations"))
    rows = pairs.select("conv_id", "turn", F.when(F.col("conv_id") % 10 == 3, "  ").otherwise(F.col("user")).alias("user_prompt"), F.coalesce("system", F.lit("default")).alias("system"), F.col("answer").alias("target"))
    return chat.encode_rows(rows, lambda c: F.transform(text.words(c), F.char_length), F.when(F.col("conv_id") % 10 == 0, "not JSON"), most=200)


@query(f"WITH {_TEMPLATE} SELECT conv_id, turn, error, CASE WHEN error IS NULL THEN n_masked + n_learned END AS n_tokens, CASE WHEN error IS NULL THEN n_masked END AS n_masked, error IS NULL AND n_masked + n_learned <= 200 AS keep FROM enc")
def encode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = F.size(F.filter("labels", lambda x: x == chat.IGNORED))
    return encoded_rows(spark, sf_dir).select("conv_id", "turn", "error", F.when(F.col("error").isNull(), F.col("n_tokens")).alias("n_tokens"), F.when(F.col("error").isNull(), masked).alias("n_masked"), F.coalesce("keep", F.lit(False)).alias("keep"))


@query(f"WITH {_TEMPLATE} SELECT count(*) AS n, max(n_masked + n_learned)::INT AS longest FROM enc WHERE error IS NULL AND n_masked + n_learned <= 200")
def longest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.longest(chat.kept_rows(encoded_rows(spark, sf_dir))[0])


_FAULTS = ("NULL", "'not JSON'", "'not an object'", "'lacks style_description'", "'lacks background or elements'", "'has nulls'", "'has ids'", "'has boxes or palettes'")


@query("SELECT doc_id, CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(_FAULTS)) + " END AS error FROM documents")
def label_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets with one fault each; their texts say null and "id": without having any."""
    said = F.concat("text", F.lit(' :null, "id": {"bbox":'))
    part = lambda *more: F.struct(said.alias("background"), F.array(F.struct(said.alias("desc"), *more)).alias("elements"))
    whole = lambda deep, style=F.struct(F.lit("x").alias("photo")): F.to_json(F.struct(said.alias("high_level_description"), style.alias("style_description"), deep.alias("compositional_deconstruction")), {"ignoreNullFields": "false"})
    good = whole(part())
    n = F.col("doc_id") % 8
    faults = [good, F.concat(F.lit("{"), good), F.concat(F.lit("["), good, F.lit("]")), F.to_json(F.struct(said.alias("high_level_description"), part().alias("compositional_deconstruction"))), whole(F.struct(said.alias("background"))), whole(part(F.lit(None).cast("string").alias("text"))), whole(part(F.lit(1).alias("id"))), whole(part(F.array(F.lit(1)).alias("bbox")))]
    target = F.when(n == 0, faults[0])
    for i, f in enumerate(faults[1:], 1):
        target = target.when(n == i, f)
    return table(spark, sf_dir, "documents").select("doc_id", jsonx.label_error(target).alias("error"))


# --- prompts, corrections, predictions


@query(f"{SELECTING}, {_LEVELS} SELECT id, detail_level, 'show ' || id AS user_prompt, 2 AS n_words, array_to_string(c, '|') AS checklist, len(g) AS n_groups, array_to_string((SELECT any_value(theme) FROM judged j WHERE j.id = levels.id), '|') AS required FROM levels WHERE length(id) % 3 <> 1 OR detail_level <> 'short'")
def prompt_row_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts joined with what they were written from; levels without a prompt are left out."""
    subs = scorers.held(selection.assemble(evaluated(spark, sf_dir)))  # read twice, chosen once
    said = F.concat(F.lit("show "), "id")
    written = subs.where((F.char_length("id") % 3 != 1) | (F.col("detail_level") != "short")).select("id", "detail_level", persona.persona(F.col("id")).alias("persona"), said.alias("user_prompt"), text.word_count(said).alias("n_words"))
    rows = curation.prompt_rows(subs, written)
    return rows.select("id", "detail_level", "user_prompt", "n_words", F.array_join("checklist", "|").alias("checklist"), F.size("menh_de_theo_nhom.groups").alias("n_groups"), F.array_join("required_facts", "|").alias("required"))


@query(f"""{GATE} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN trim('fixed ' || prompt) ELSE prompt END AS user_prompt, CASE WHEN doc_id % 2 = 1 THEN trim('fixed ' || prompt) END AS attempted_prompt, doc_id % 2 = 0 AS recovered, CASE WHEN doc_id % 2 = 1 THEN 'missing 1 core facts' END AS why
FROM verdicts WHERE is_judged AND NOT is_passed AND doc_id % 7 <> 0""")
def correct_and_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected prompts corrected by one scorer and judged anew by another: those recovered, and those rejected for good. A writer that fails leaves its row out."""

    def writer():
        def ask(messages):
            if int(messages[0]["content"]) % 7 == 0:
                raise ValueError("refused")
            return "  fixed  " + messages[-1]["content"]

        return ask

    def judge():
        return lambda messages: '{"missing": [], "extra": []}' if int(messages[0]["content"]) % 2 == 0 else '{"missing": ["a fact"], "extra": []}'

    bad = decided(spark, sf_dir).where("not decision.passed").select("doc_id", F.col("prompt").alias("user_prompt"))
    ask = lambda c: chat.messages(F.col("doc_id").cast("string"), c)
    verdict = lambda raw: gate.decide(gate.missing_items(F.get_json_object(raw, "$.missing")), gate.extra_items(F.get_json_object(raw, "$.extra")))
    attempts = scorers.corrected_and_judged(bad, writer, judge, "doc_id", ask(F.col("user_prompt")), ask, verdict)
    good, final = gate.after_correction(bad, attempts.where("error is null").drop("error"), ["doc_id"])
    good = good.select("doc_id", "user_prompt", F.lit(None).cast("string").alias("attempted_prompt"), F.lit(True).alias("recovered"), F.lit(None).cast("string").alias("why"))
    return good.unionByName(final.select("doc_id", "user_prompt", "attempted_prompt", F.lit(False).alias("recovered"), F.array_join("reject_after_retry.reasons", "; ").alias("why")))


@query("""SELECT o_orderkey AS id, v AS variant, CASE WHEN o_orderkey % 4 <> 0 THEN '{"k":' || o_orderkey || '}' END AS pred_json, CASE WHEN o_orderkey % 4 = 0 THEN 'no braces' END AS parse_error, o_orderkey % 9 >= 8 AS hit_max_new_tokens FROM orders, (VALUES ('adapter'), ('baseline')) AS t(v)""")
def prediction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of both variants as predictions."""
    n = F.col("o_orderkey")
    raw = F.when(n % 4 == 0, "nothing here").otherwise(F.concat(F.lit('<think>{}</think>```json\n{"k":'), n.cast("string"), F.lit("}\n```")))
    rows = table(spark, sf_dir, "orders").select(n.alias("id"), F.lit("long").alias("mode"), F.lit("p").alias("user_prompt"), raw.alias("raw_output"), F.lit(3).alias("n_input_tokens"), (n % 9).cast("int").alias("n_output_tokens"), F.lit(0.1234).alias("gen_seconds"))
    every = prediction.each_variant(rows, prediction.variants(True, True), lambda df, name: prediction.record(df, name, 8))
    return every.select("id", "variant", "pred_json", "parse_error", "hit_max_new_tokens")


@query("SELECT o_orderkey AS id, mode FROM (SELECT o_orderkey, ['short', 'medium', 'long'][1 + o_orderkey % 3] AS mode FROM orders) WHERE mode <> 'medium' ORDER BY o_orderkey LIMIT 50")
def chosen_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of some modes; the limit is the feature."""
    mode = F.get(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), (F.col("o_orderkey") % 3).cast("int"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), mode.alias("mode"), F.col("o_orderkey").alias("ord"))
    return prediction.chosen(rows, ["short", "long"], 50).select("id", "mode")


@query("""SELECT o_orderkey AS id, o_orderkey % 3 + 1 AS attempt, CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 2 = 1 THEN 'short' ELSE '' END AS errors FROM orders""")
def repair_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers checked and asked again with their errors, up to three rounds; the last answer stays with what is still wrong."""

    def make():
        def ask(messages):
            n, tries = int(messages[0]["content"]), sum(m["role"] == "assistant" for m in messages)
            return "x" * 9 if tries >= n % 3 and not (n % 3 == 2 and n % 2 == 1) else "x"

        return ask

    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), chat.messages(F.col("o_orderkey").cast("string"), F.lit("go")).alias("messages"))
    check = lambda raw: F.when(F.char_length(raw) < 5, F.array(F.lit("short"))).otherwise(F.array().cast("array<string>"))
    done = scorers.repaired(rows, make, "id", check, chat.repair_message)
    return done.select("id", F.col("attempt").cast("long").alias("attempt"), F.array_join("errors", ";").alias("errors"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'hi ' || o_orderkey END AS said FROM orders")
def chat_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of chat-completion answers; null where they have none."""
    n = F.col("o_orderkey")
    body = F.when(n % 3 == 0, F.format_string('{"choices": [{"message": {"content": "hi %d"}}]}', n)).when(n % 3 == 1, '{"choices": []}').otherwise("oops")
    return table(spark, sf_dir, "orders").select(n.alias("id"), jsonx.chat_content(body).alias("said"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'seen ' || c_custkey END AS raw_output, CASE WHEN c_custkey % 11 = 0 THEN 'ScoreError: refused with 400: no' END AS error FROM customer")
def chat_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat client against a stand-in for the network: throttled at first and then answered, or refused at once."""

    def make():
        import json

        tried: dict[bytes, int] = {}

        def send(url, data, head, timeout):
            said = json.loads(data)["messages"][-1]["content"]
            tried[data] = tried.get(data, 0) + 1
            if int(said) % 11 == 0:
                return 400, "no"
            return (429, "") if tried[data] == 1 and int(said) % 2 else (200, json.dumps({"choices": [{"message": {"content": f"seen {said}"}}]}))

        return chat_http.client("http://model.invalid/v1", "m", send=send, sleep=lambda s: None)

    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), chat.messages(F.lit("s"), F.col("c_custkey").cast("string")).alias("messages"))
    return scorers.score(rows, make, "id", workers=4)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '' END AS required, CASE WHEN c_custkey % 4 = 0 THEN '-' ELSE printf('%.1f%%', (c_custkey % 100)::DOUBLE) END AS rate FROM customer")
def required_and_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required facts from a list, an older single one or none; and shares as text."""
    n = F.col("c_custkey")
    listed = F.when(n % 3 == 0, F.array("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(gate.required_facts(listed, F.when(n % 3 == 1, F.col("c_mktsegment"))), "|").alias("required"), text.percent(n % 100, F.when(n % 4 == 0, 0).otherwise(100)).alias("rate"))
