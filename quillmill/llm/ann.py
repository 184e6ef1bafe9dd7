"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (iterative quantisation) turns each vector into a binary code whose Hamming
distance follows the angle. Codes are split into substrings of 16 bits and each substring is indexed. If two codes
differ in at most r bits, then by the pigeonhole principle some substring differs in at most its share of r; so looking up
every value within that share of the query's substring, in each index, retrieves every code within r. Those that are
within r are reranked by cosine in double precision on the original vectors.

The radius is learned with the rotation: so that it holds nearly all of the sample's own nearest neighbours. As a sample is
sparser than the whole, its neighbours are farther than the whole's, so the radius errs on the safe side.

Each row lies in one partition, which is cut into blocks of about BLOCK_BYTES; a block's index is built once for each batch of queries, and
batches of about BATCH_BYTES are broadcast, so that rows are never copied or shuffled for a query. A block returns each query's k best. Blocks do not depend on what the
vectors are, so equal or crowded vectors gather nowhere. A substring's ball is probed by its own values or, where fewer, by the values that the block holds. Queries that
find fewer than k rows in their radius are reranked against all rows, so results are always full. Where neighbours are hardly nearer than
chance the radius is large, and then every such search looks at much of the data: the work is queries times rows, the moved data is not.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, as
query or as candidate, and neither do rows with a null vec_id; rows repeated under one vec_id count once, as the vector that is least in order; fewer candidates than k give fewer
rows; ties go to the smaller vec_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_hash, checkpointed, partitions

SUB = 16
BLOCK_BYTES, BATCH_BYTES = 33_554_432, 33_554_432
#: Rows that a partition has at least, where there are so many.
PART_ROWS = 4096


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, which rounds nothing, so that its largest component is near 1 and no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(abs(x).max(1))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def learn(sample: np.ndarray, bits: int = 128, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """A matrix that maps unit vectors to bits numbers whose signs are the code; rotations side by side if bits exceed the dimension."""
    rng, parts, left = np.random.default_rng(seed), [], bits
    x = units(sample)
    _, _, axes = np.linalg.svd(x.T @ x)
    while left > 0:
        v = x @ axes[: min(left, x.shape[1])].T
        r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (u @ w).T
        parts.append(axes[: v.shape[1]].T @ r)
        left -= v.shape[1]
    return np.hstack(parts)


def codes(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Substrings of each code as numbers of 16 bits."""
    return np.packbits(units(x) @ rotation > 0, axis=1).view(np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def radius(sample: np.ndarray, rotation: np.ndarray, k: int, share: float = 0.98, queries: int = 256) -> int:
    """Within it lie so large a share of the sample's k nearest pairs."""
    x, c = units(sample), codes(sample, rotation)
    found = []
    for q in range(min(queries, len(x))):
        s = x @ x[q]
        s[q] = -2
        found.append(hamming(c[np.argsort(-s)[:k]], c[q]))
    return int(np.ceil(np.quantile(np.concatenate(found), share))) if found else SUB


@cache
def flips(t: int) -> np.ndarray:
    """Every change of a substring within so many bits."""
    return np.array([sum(1 << i for i in c) for n in range(t + 1) for c in combinations(range(SUB), n)], np.uint16)


class Index:
    """Rows of a block by each substring's value."""

    def __init__(self, code: np.ndarray, r: int) -> None:
        self.code, self.r = code, r
        m = code.shape[1]
        a, rest = divmod(r, m)
        # Were every substring beyond its share, the differing bits would sum to more than r.
        self.shares = [a] * (rest + 1) + [a - 1] * (m - rest - 1)
        self.order = [np.argsort(code[:, j], kind="stable") for j in range(m)]
        self.keys, self.begin = [], []
        for j, o in enumerate(self.order):
            keys, begin = np.unique(code[o, j], return_index=True)
            self.keys.append(keys)
            self.begin.append(np.append(begin, len(o)))

    def probed(self, j: int, value: np.uint16) -> np.ndarray:
        """Places among a substring's keys of all those within its share of a value: by the ball's values or by the keys, whichever are fewer."""
        keys, share = self.keys[j], self.shares[j]
        if share < 0:
            return np.zeros(0, np.intp)
        if len(ball := flips(min(share, SUB))) < len(keys):
            wanted = ball ^ value
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return at[keys[at] == wanted]
        return np.flatnonzero(np.bitwise_count(keys ^ value) <= share)

    def within(self, query: np.ndarray) -> np.ndarray:
        """Numbers of all rows whose code differs in at most r bits."""
        seen = np.zeros(len(self.code), bool)
        for j, o in enumerate(self.order):
            at = self.probed(j, query[j])
            lo, n = self.begin[j][at], self.begin[j][at + 1] - self.begin[j][at]
            seen[o[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]] = True
        rows = np.flatnonzero(seen)
        return rows[hamming(self.code[rows], query) <= self.r]


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def best_of(ids: np.ndarray, x: np.ndarray, index: Index | None, query_ids: np.ndarray, queries: np.ndarray, query_codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the k rows of largest cosine among those in each query's radius; among all rows if there is no index."""
    norms, query_norms = np.sqrt((x * x).sum(1)), np.sqrt((queries * queries).sum(1))
    everything, out = np.arange(len(ids)), []
    for q, v, c, norm in zip(query_ids, queries, query_codes, query_norms, strict=True):
        near = index.within(c) if index else everything
        near = near[ids[near] != q]
        score = (x[near] * v).sum(1) / (norms[near] * norm)
        best = np.lexsort((ids[near], -score))[:k]
        out.append((np.full(len(best), q), ids[near][best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def searched(rows: DataFrame, queries: DataFrame, n_queries: int, width: int, rotation: np.ndarray, reach: int | None, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each query the k best rows of each block, within the reach if there is one."""
    batches = max(1, -(-n_queries * width * 8 // BATCH_BYTES))
    block, out = max(1024, BLOCK_BYTES // (8 * width)), None
    context = rows.sparkSession.sparkContext
    for number in range(batches):
        # A batch has about BATCH_BYTES, by the hash of its ids.
        drawn = queries.where(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(batches)) == number).select("vec_id", "v").toArrow()
        if not drawn.num_rows:
            continue
        q = scaled(drawn.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width))
        held = context.broadcast((drawn.column("vec_id").to_numpy(), q, codes(q, rotation)))

        def run(frames: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            def done(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
                ids, x = (np.concatenate(c) for c in zip(*parts, strict=True))
                found = best_of(ids, x, None if reach is None else Index(codes(x, rotation), reach), *held.value, k)
                return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

            parts, n = [], 0
            for frame in frames:
                parts.append((frame.column(0).to_numpy(), scaled(frame.column(1).flatten().to_numpy().reshape(-1, width))))
                n += frame.num_rows
                if n >= block:
                    yield done(parts)
                    parts, n = [], 0
            if n:
                yield done(parts)

        found = checkpointed(rows.mapInArrow(run, "query_id long, vec_id long, score double"))
        out = found if out is None else out.unionByName(found)
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, bits: int = 128, sample: int = 20_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank int, vec_id, score double): each query's k nearest rows found, itself left out."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce(usable(F.col("v")), F.lit(False)) & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, width = size["count"], size["n"]
    # As many partitions as the session shuffles into, if these have enough rows; an index over few rows costs as much as a scan.
    parts = max(1, min(partitions(vectors.sparkSession), n // PART_ROWS), n * width * 8 // (4 * BLOCK_BYTES))
    rows = checkpointed(rows.where(F.size("v") == width).repartition(parts, "vec_id"))
    drawn = scaled(by_hash(rows, sample, "vec_id").select("v").toArrow().column("v").combine_chunks().flatten().to_numpy().reshape(-1, width))
    rotation = learn(drawn, bits)
    queries = rows.where(is_query)
    n_queries = queries.count()
    if not n_queries:
        return vectors.sparkSession.createDataFrame([], schema)
    found = searched(rows, queries, n_queries, width, rotation, radius(drawn, rotation, k), k)
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, n - 1)).select(F.col("query_id").alias("vec_id"))
    short = checkpointed(queries.join(full, "vec_id", "left_anti"))
    if n_short := short.count():
        every = searched(rows, short, n_short, width, rotation, None, k)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(every)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
