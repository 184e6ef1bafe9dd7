"""The training-corpus pipeline: what documents go through before they are packed into sequences.

Each stage is a function of (spark, docs, sf_dir), works on all that its predecessor kept, and its decisions take effect:
toxic documents go, repeated lines go, all but one document of each group of near-duplicates go, documents that
hold a benchmark item go, and what is left is packed. All stages but the last return the columns of documents, whose
n_chars follows the text.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, linededup, packing, simhash, toxicity
from quillmill.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

#: A trained machine, fingerprints and edit distances are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
