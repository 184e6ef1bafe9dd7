"""Quality selection by importance resampling.

Texts become bags of hashed n-grams (words and word pairs, in BUCKETS buckets). Two generative models, one of
target text and one of the raw corpus, give each document its importance weight, the ratio of its probabilities under the two: the log weight is the sum of
its n-grams' log ratios. Gumbel noise on the log weights and a top k make it a sample without replacement, in proportion to the weights.

The raw model counts every document. The target model counts labelled documents of good quality, at most max_target of them by the hash of
their id: a list that size is broadcast, so texts are not shuffled. The counts are two arrays per task. The k-th largest
key is found by counting keys in ever narrower ranges, exactly, so nothing is sorted in one place.

Defined results: null and empty texts have log weight 0, as a text without evidence; ties at the last place are broken by
doc_id; repeated rows are drawn alike; an empty table, or no target documents, gives log weights of 0; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_hash, checkpointed, slices, texts

BUCKETS = 10_000
KEPT = 1_000_000
TOKEN = re.compile(r"\w+|[^\w\s]+")


class Grams:
    """Bucket counts of texts; words' hashes are kept, up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def counts(self, text: str) -> np.ndarray:
        words = TOKEN.findall(text.lower())
        if len(self.known) > KEPT:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        return np.concatenate([h % np.uint64(BUCKETS), (pairs >> np.uint64(20)) % np.uint64(BUCKETS)]).astype(np.int64)


def models(docs: DataFrame, target_ids: DataFrame, max_target: int = 20_000) -> np.ndarray:
    """The log ratio of the target's and the corpus's share of each bucket."""
    ids = docs.sparkSession.sparkContext.broadcast({r[0] for r in by_hash(target_ids.distinct(), max_target, "doc_id").collect()})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(), np.zeros((2, BUCKETS), np.int64)
        for keys, rows in slices(batches):
            for key, x in zip(keys, rows, strict=True):
                n = np.bincount(grams.counts(x.decode("utf-8", "replace")), minlength=BUCKETS)
                total[0] += n
                if key in ids.value:
                    total[1] += n
        yield pa.RecordBatch.from_arrays([pa.array(range(BUCKETS), pa.int32()), pa.array(total[0], pa.int64()), pa.array(total[1], pa.int64())], names=["bucket", "raw", "target"])

    counted = texts(docs).mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.collect():  # BUCKETS rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def log_weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, n_grams long, log_weight double), a row for each row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for keys, rows in slices(batches):
            found = [grams.counts(x.decode("utf-8", "replace")) for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array([float(held.value[x].sum()) for x in found], pa.float64())], names=["doc_id", "n_grams", "log_weight"])

    return texts(docs).mapInArrow(run, "doc_id long, n_grams long, log_weight double")


def gumbel(key: Column, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def top_k(rows: DataFrame, by: str, tie: str, k: int, ranges: int = 4096) -> DataFrame:
    """Exactly the k rows of largest by, ties to the smaller tie (and whole where both are equal). Only counts of ranges come to the driver."""
    rows = checkpointed(rows)
    lo, hi, n = rows.agg(F.min(by), F.max(by), F.count("*")).first()
    if k >= n or k <= 0:
        return rows if k > 0 else rows.limit(0)
    above = 0  # rows beyond hi's range so far
    while lo < hi:
        width = (hi - lo) / ranges
        if width <= 0 or lo + width == lo:
            break
        place = F.least(F.lit(ranges - 1), F.floor((F.col(by) - F.lit(lo)) / F.lit(width)).cast("int"))
        inside = rows.where((F.col(by) >= lo) & (F.col(by) <= hi))
        found = inside.groupBy(place.alias("p")).agg(F.count("*").alias("n"), F.min(by).alias("lo"), F.max(by).alias("hi")).orderBy(F.desc("p")).collect()
        for r in found:
            if above + r["n"] >= k:
                now = (r["lo"], r["hi"])
                break
            above += r["n"]
        if now == (lo, hi):
            break
        lo, hi = now
    # From here on, rows in [lo, hi] are equal in by, or as good as: order these few by both columns.
    rest = rows.where((F.col(by) >= lo) & (F.col(by) <= hi)).orderBy(F.desc(by), tie).limit(k - above)
    return rows.where(F.col(by) > hi).unionByName(rest)


def resample(docs: DataFrame, labels: DataFrame, keep: float | None = None, seed: int = 11, max_target: int = 20_000) -> DataFrame:
    """(doc_id, log_weight, key) of the documents drawn. keep: their share of all; by default the share of good ones among labelled documents."""
    good = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    weights = log_weights(docs, models(docs, good.where("quality = 1").select("doc_id"), max_target))
    keyed = checkpointed(weights.withColumn("key", F.col("log_weight") + gumbel(F.coalesce(F.col("doc_id"), F.lit(-1)), seed)).select("doc_id", "log_weight", "key"))
    if keep is None:
        keep = good.agg(F.avg("quality")).first()[0] or 1.0
    return top_k(keyed, "key", "doc_id", int(round(keep * keyed.count())))
