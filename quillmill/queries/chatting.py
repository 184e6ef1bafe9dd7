"""Queries on chat rows, encodings, predictions and incremental work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import chat, prediction, split
from ..plans import incremental, scorers
from .adapters import wc
from .registry import query, table

_PAIRS = "pairs AS (SELECT conv_id, turn, system, text AS usr, answer FROM (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer, last_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS system FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"


@query(f"WITH {_PAIRS} SELECT conv_id, turn, 3 AS n_messages, coalesce(system, 'default') AS system, usr, answer FROM pairs")
def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.pair_turns(table(spark, sf_dir, "conversations"))
    m = chat.messages(F.coalesce("system", F.lit("default")), F.col("user"), F.col("answer"))
    return pairs.select("conv_id", "turn", m.alias("m")).select("conv_id", "turn", F.size("m").alias("n_messages"), F.col("m")[0]["content"].alias("system"), F.col("m")[1]["content"].alias("usr"), F.col("m")[2]["content"].alias("answer"))


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with a tokenizer of words to their lengths."""
    pairs = chat.pair_turns(table(spark, sf_dir, "conversations"))
    ids = lambda c: F.transform(words(c), F.char_length)
    return pairs.select("conv_id", "turn", chat.masked(ids(F.col("user")), F.concat(ids(F.col("user")), ids(F.col("answer")))).alias("x")).select("conv_id", "turn", "x.*")


@query(f"WITH {_PAIRS} SELECT conv_id, turn, {wc('usr')} + {wc('answer')} AS n_tokens, {wc('usr')} AS n_masked, {wc('answer')} AS n_learned FROM pairs")
def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, sf_dir).select("conv_id", "turn", F.size("input_ids").alias("n_tokens"), F.size(F.filter("labels", lambda x: x == chat.IGNORED)).alias("n_masked"), F.size(F.filter("labels", lambda x: x != chat.IGNORED)).alias("n_learned"))


@query(f"WITH {_PAIRS}, lens AS (SELECT conv_id, turn, conv_id % 50 AS batch, {wc('usr')} + {wc('answer')} AS n FROM pairs) SELECT conv_id, turn, (ceil(max(n) OVER (PARTITION BY batch) / 8.0) * 8)::INT AS width, (ceil(max(n) OVER (PARTITION BY batch) / 8.0) * 8 - n)::INT AS n_pad FROM lens")
def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = chat.pad_batches(encoded(spark, sf_dir).drop("attention_mask").withColumn("batch", F.col("conv_id") % 50), "batch")
    return padded.select("conv_id", "turn", F.size("input_ids").alias("width"), F.size(F.filter("attention_mask", lambda x: x == 0)).alias("n_pad"))


@query(f"WITH {_PAIRS}, lens AS (SELECT conv_id % 50 AS batch, {wc('usr')} AS p, {wc('usr')} + {wc('answer')} AS n FROM pairs) SELECT batch, least((ceil(max(n) / 8.0) * 8)::INT, (ceil(max(n) / 8.0) * 8)::INT - min(p)::INT + 1)::INT AS suffix FROM lens GROUP BY batch")
def supervised_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = chat.pad_batches(encoded(spark, sf_dir).drop("attention_mask").withColumn("batch", F.col("conv_id") % 50), "batch")
    return chat.supervised_lengths(padded, "batch")


@query(f"WITH {_PAIRS}, c AS (SELECT {wc('usr')} + {wc('answer')} AS n, conv_id % 10 = 0 AS bad FROM pairs) SELECT count(*) FILTER (WHERE NOT bad AND n <= 60) AS n_valid, count(*) FILTER (WHERE bad) AS n_invalid, count(*) FILTER (WHERE NOT bad AND n > 60) AS n_too_long FROM c")
def prepare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(spark, sf_dir).select(F.size("input_ids").alias("n_tokens"), F.when(F.col("conv_id") % 10 == 0, "bad").alias("error"))
    return chat.prepared_counts(rows, most=60)


@query("SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'Write briefly.' WHEN 1 THEN 'Write some.' ELSE 'Write at length.' END AS system FROM conversations WHERE role = 'user'")
def system_prompt_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = spark.createDataFrame([("short", "Write briefly."), ("medium", "Write some."), ("long", "Write at length.")], "level string, system string")
    rows = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.get(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), (F.col("turn") % 3).cast("int")).alias("mode"))
    return chat.with_system(rows, prompts).select("conv_id", "turn", "system")


@query("SELECT count(*) FILTER (WHERE o_orderkey % 4 <> 0) AS written, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS missing, count(*) FILTER (WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 = 0) AS parse_failed, count(*) FILTER (WHERE o_orderkey % 4 <> 0 AND o_orderkey % 7 = 0) AS truncated FROM orders")
def merge_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    tests = table(spark, sf_dir, "orders").select(n.alias("id"), F.lit("long").alias("mode"))
    held = table(spark, sf_dir, "orders").where(n % 4 != 0).select(n.alias("id"), F.lit("long").alias("mode"), F.when(n % 5 == 0, "no braces").alias("parse_error"), (n % 7 == 0).alias("hit_max_new_tokens"))
    return prediction.merge_counts(tests, held)


@query("SELECT shard, count(*) AS n, min(ord) AS first, max(ord) AS last FROM (SELECT ord, ord % 8 AS shard FROM (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ord FROM orders)) GROUP BY shard")
def strided_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.numbered(table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    return split.strided_shard(rows, "ord", 8).groupBy("shard").agg(F.count("*").alias("n"), F.min("ord").alias("first"), F.max("ord").alias("last"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 1")
def incremental_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache that has a third of the orders, half of these by an old fingerprint."""
    stamp = incremental.fingerprint(F.col("o_orderkey"), F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").withColumn("fingerprint", stamp).select("o_orderkey", "fingerprint")
    cache = rows.where("o_orderkey % 3 = 0").withColumn("fingerprint", F.when(F.col("o_orderkey") % 2 == 0, F.col("fingerprint")).otherwise("old"))
    return incremental.todo(rows, cache, ["o_orderkey"]).select("o_orderkey")


@query("SELECT o_custkey, o_orderkey AS last_order, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("last_order"), "o_orderpriority")
    return split.last_of(rows, ["o_custkey"], "last_order")


@query("SELECT o_custkey, o_orderkey, min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS best_so_far, coalesce(o_totalprice < min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_best FROM orders")
def running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double").alias("loss"))
    return chat.running_best(rows, "o_custkey", "o_orderkey", "loss").select("o_custkey", "o_orderkey", "best_so_far", "is_best")


@query("SELECT c_custkey, sha1('{\"c_custkey\":' || c_custkey || ',\"c_mktsegment\":\"' || c_mktsegment || '\",\"c_nationkey\":' || c_nationkey || '}') AS fingerprint FROM customer")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint of a row's inputs."""
    return table(spark, sf_dir, "customer").select("c_custkey", incremental.fingerprint(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")).alias("fingerprint"))


@query("SELECT conv_id, turn, text || ' indeed' AS raw_output, NULL AS error FROM conversations WHERE role = 'user' AND conv_id % 5 <> 0 UNION ALL SELECT conv_id, turn, NULL, 'ValueError: refused' FROM conversations WHERE role = 'user' AND conv_id % 5 = 0")
def scorer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer that agrees and fails on some rows: failures stay with their rows."""

    def make():
        def ask(messages):
            if messages[0]["content"] == "fail":
                raise ValueError("refused")
            return messages[-1]["content"] + " indeed"

        return ask

    turns = table(spark, sf_dir, "conversations").where("role = 'user'").select(F.concat_ws("/", "conv_id", "turn").alias("key"), chat.messages(F.when(F.col("conv_id") % 5 == 0, "fail").otherwise("go"), F.col("text")).alias("messages"))
    scored = scorers.score(turns, make, "key")
    return scored.select(F.split("key", "/")[0].cast("long").alias("conv_id"), F.split("key", "/")[1].cast("long").alias("turn"), "raw_output", "error")
