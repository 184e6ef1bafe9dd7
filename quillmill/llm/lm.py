"""Stupid-backoff language-model scores, from counts of the whole corpus.

A word's score given the words before it is count(n-gram) / count(its context) for the longest n-gram that the corpus holds
at least min_count times, times alpha for each order given up; a single word's is count / corpus size. A document's score
is the sum of logs.

As relations: documents are dealt by the hash of their id to blocks of about BLOCK_BYTES. A block explodes its n-grams of all
orders, keeps each once with its number (a frequent word pair is one entry per block, however often it occurs), and sends
them, as packed 64-bit hashes, to the partition of the count table that their hash falls in. There counts are summed over blocks and
joined back to the blocks that asked. A block then looks up its documents' n-grams and sums per document. Texts are
shuffled once, n-grams once per block, and counts once back; what moves grows in proportion to the corpus.

Defined results: a null or empty text, or one without words, has no words and score 0; repeated rows count and are
scored each; an empty table gives an empty result; extra columns are ignored; a null doc_id is scored like any other, and rows
of one id, or of none, are dealt by their texts; a very long text is a row like others, held by its task in words of 8 bytes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, partitions, texts

BLOCK_BYTES = 6_000_000
#: Packed n-grams that a partition of the count table receives, about.
PART_ENTRIES = 2_000_000


def pack(counts: np.ndarray) -> bytes:
    """Counts as a byte each, 255 for those beyond, which follow in full."""
    return zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.uint64).tobytes(), 1)


def unpack(packed: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(packed)
    out = np.frombuffer(raw[:n], np.uint8).astype(np.uint64)
    out[out == 255] = np.frombuffer(raw[n:], np.uint64)
    return out


def word_hashes(text: str, known: dict[bytes, int]) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w, 42)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order, the hash of the n-gram that begins at each word."""
    out = [h]
    for n in range(2, order + 1):
        z = (out[-1][: max(0, len(h) - n + 1)] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) ^ h[n - 1 :]
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(z ^ (z >> np.uint64(32)))
    return out


def score_words(grams: list[np.ndarray], counts: list[np.ndarray], alpha: float, min_count: int) -> tuple[float, int]:
    """The sum of logs without the corpus size, and how many words were scored by their own count."""
    n = len(grams[0])
    total, open_ = np.zeros(n), np.ones(n, bool)
    for k in range(min(len(grams), n), 1, -1):
        last = np.arange(k - 1, n)  # words that have k - 1 before them
        hit = open_[last] & (counts[k - 1] >= min_count)
        total[last[hit]] += np.log(counts[k - 1][hit]) - np.log(counts[k - 2][: n - k + 1][hit])
        open_[last[hit]] = False
        total[last[open_[last]]] += np.log(alpha)
    total[open_] += np.log(counts[0][open_])
    return float(total.sum()), int(open_.sum())


def scores(docs: DataFrame, order: int = 2, alpha: float = 0.4, min_count: int = 2) -> DataFrame:
    """(doc_id, n_words long, n_backed_off long, log_score double): n_backed_off words had no n-gram of two or more words."""
    rows = texts(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    parts = partitions(docs.sparkSession, size / 6 * order / PART_ENTRIES)
    spread = min(blocks, partitions(docs.sparkSession))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(blocks))).repartition(spread, "block")

    def entries(frame: pd.DataFrame) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
        """n-grams by document; all distinct ones by part and value, how often, and where each part ends."""
        known: dict[bytes, int] = {}
        grams = [gram_hashes(word_hashes(t, known), order) for t in frame["text"]]
        found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *(g for d in grams for g in d)]), return_counts=True)
        part = ((found >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # rises with the value
        return grams, found, n, np.searchsorted(part, np.arange(parts + 1))

    def ask(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, found, n, ends = entries(frame)
        full = np.flatnonzero(np.diff(ends))
        return pd.DataFrame({"block": int(key[0]), "part": full, "grams": [found[ends[p] : ends[p + 1]].tobytes() for p in full], "counts": [pack(n[ends[p] : ends[p + 1]]) for p in full]})

    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        grams = np.frombuffer(b"".join(frame["grams"]), np.uint64)
        _, which = np.unique(grams, return_inverse=True)
        totals = np.bincount(which, np.concatenate([unpack(c, len(x) // 8) for c, x in zip(frame["counts"], frame["grams"], strict=True)])).astype(np.uint64)[which]
        ends = np.cumsum([0, *(len(x) // 8 for x in frame["grams"])])
        return pd.DataFrame({"block": frame["block"], "part": int(key[0]), "counts": [pack(totals[a:b]) for a, b in zip(ends, ends[1:], strict=False)]})

    def tell(key: tuple, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("part")
        grams, found, _, ends = entries(frame)
        counts = np.concatenate([np.zeros(0, np.uint64), *(unpack(c, ends[p + 1] - ends[p]) for p, c in zip(answers["part"], answers["counts"], strict=True))])
        at = [[counts[np.searchsorted(found, g)] for g in d] for d in grams]
        done = [score_words(g, c, alpha, min_count) if len(g[0]) else (0.0, 0) for g, c in zip(grams, at, strict=True)]
        return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_words": [len(g[0]) for g in grams], "n_backed_off": [x[1] for x in done], "partial": [x[0] for x in done]})

    asked = dealt.groupBy("block").applyInPandas(ask, "block long, part int, grams binary, counts binary")
    answered = asked.repartition(parts, "part").groupBy("part").applyInPandas(count, "block long, part int, counts binary")
    told = dealt.groupBy("block").cogroup(answered.repartition(spread, "block").groupBy("block")).applyInPandas(tell, "doc_id long, n_words long, n_backed_off long, partial double")
    told = checkpointed(told)
    words = told.agg(F.sum("n_words")).first()[0] or 1
    return told.select("doc_id", "n_words", "n_backed_off", (F.col("partial") - F.col("n_backed_off") * float(np.log(words))).alias("log_score"))
