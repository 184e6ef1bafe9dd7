"""Document fingerprints by context-triggered piecewise hashing.

The bytes of a text are hashed in a rolling window of WINDOW bytes (zeros stand before the text). At level k a chunk ends
where the k highest bits of the window's hash are zero, so an edit moves no chunk's end but those near it. A chunk's value is the
sum of its windows' hashes, told by twelve bits, two letters. A text's level is the lowest that gives at most MOST - 1 ends; its fingerprint is
the level, the signature at this level, and the signature one level higher, where each chunk joins some of the lower ones. A text is read
once in blocks, whatever its length: ends are dropped as the level rises, and sums are differences of running sums.

Two fingerprints are compared at the levels that both have, as ssdeep does with block sizes: the likeness is 1 - d / (m + n), where m and n are the chunks of the two signatures and d the least number of chunks put in
or taken out to make one of the other (bit-parallel); the larger likeness of the levels in common counts, 0 if there is none.

Rows are dealt by ranges of their ids, so that a document meets the next one without a window over
all. What stands at the edge of a partition is written with its text, and met in a join of two rows for each partition.

Defined results: a null text is empty; the fingerprint of an empty text is "0::", and two of these are alike by 1; rows are in falling order of doc_id, null ids last, rows of one id in the order of a
hash of their text, equal rows in any order; so repeated rows are documents of their own, next to each other; an empty table gives no rows; a single row is its own next document; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, slices, texts, written

WINDOW = 8
MOST = 64
BLOCK = 1 << 17
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_PAIRS = [a + b for a in LETTERS for b in LETTERS]
_ODD_INT, _FULL = 0x9E3779B97F4A7C15, (1 << 64) - 1
_ODD = np.uint64(_ODD_INT)


def window_hashes(padded: bytes) -> np.ndarray:
    """For each byte but the first WINDOW - 1, a hash of the WINDOW bytes that end there."""
    h = np.ndarray(len(padded) - WINDOW + 1, "<u8", padded, 0, (1,)).copy()  # eight bytes, one further each time
    h *= _ODD
    h ^= h >> np.uint64(32)
    h *= _ODD
    return h


def signature(sums: list[int]) -> str:
    """Two letters for each chunk, from the running sums at the chunks' ends."""
    return "".join([_PAIRS[((b - a) * _ODD_INT & _FULL) >> 52] for a, b in zip([0, *sums], sums)])  # noqa: B905


def fingerprint(text: bytes, least: int | None = None) -> str:
    """least: a level that is surely not too high; by default one that rarely is, and then zero is taken."""
    if not text:
        return "0::"
    start = max(0, (len(text) // MOST).bit_length() - 2) if least is None else least
    level, total, kept = start, np.uint64(0), []
    for at in range(0, len(text), BLOCK):
        part = text[max(0, at - WINDOW + 1) : at + BLOCK]
        h = window_hashes(part if at else bytes(WINDOW - 1) + part)
        running = np.cumsum(h)
        running += total
        total = running[-1]
        new = np.flatnonzero(h <= _FULL >> level)
        kept += zip(h[new].tolist(), running[new].tolist(), strict=True)
        while len(kept) >= MOST:
            level += 1
            kept = [x for x in kept if x[0] <= _FULL >> level]
    if level == start > 0 and least is None:
        return fingerprint(text, 0)
    last, signs = int(h[-1]), []
    for k in (level, level + 1):
        sums = [x[1] for x in kept if x[0] <= _FULL >> k]
        signs.append(signature(sums if last <= _FULL >> k else [*sums, int(total)]))
    return f"{level}:{signs[0]}:{signs[1]}"


def common_chunks(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence, by bits of one number."""
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if u := v & where.get(x, 0):
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, 0 to 1; 1 for equal ones."""
    if a == b:
        return 1.0
    (level_a, *sig_a), (level_b, *sig_b) = a.split(":"), b.split(":")
    best = 0.0
    for i in (0, 1):
        for j in (0, 1):
            if int(level_a) + i == int(level_b) + j and sig_a[i] and sig_b[j]:
                x, y = ([s[k : k + 2] for k in range(0, len(s), 2)] for s in (sig_a[i], sig_b[j]))
                best = max(best, 2 * common_chunks(x, y) / (len(x) + len(y)))
    return best


def _decoded(text: bytes) -> str:
    return text.decode("utf-8", "surrogateescape")


def edited(text: str, after: str) -> bytes:
    """The last half of text's code points, rounded down, replaced by the first as many of what comes after."""
    half = len(text) // 2
    return (text[: len(text) - half] + after[:half]).encode("utf-8", "surrogateescape")


def compare(doc_id: int | None, text: bytes, own: str, after: bytes, next_print: str) -> tuple:
    t = _decoded(text)
    new = edited(t, _decoded(after[: 2 * len(text)]) if len(after) > 2 * len(text) else _decoded(after))
    changed = own if new == text else fingerprint(new)
    return doc_id, len(t), hashlib.sha256(new).hexdigest(), own, changed, likeness(own, changed), likeness(own, next_print)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): a row for each row of docs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(map(fingerprint, rows), pa.string())], names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


RESULT = ("doc_id long", "n_chars long", "edited_sha256 string", "fingerprint string", "edited_fingerprint string", "near_edited double", "near_next double")
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
NAMES = [x.split()[0] for x in RESULT]


def _arrays(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], _TYPES[x.split()[1]]) for k, x in enumerate(RESULT)]


def neighbours(docs: DataFrame) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and how alike they and the next document's are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: a result; 1 and 2: a partition's last and first row, with their texts."""
        part, before = TaskContext.get().partitionId(), None

        def edge(kind: int, row: tuple) -> pa.RecordBatch:
            blank = (row[0], None, None, row[2], None, None, None)
            return pa.RecordBatch.from_arrays([*_arrays([blank]), pa.array([kind], pa.int32()), pa.array([part], pa.int64()), pa.array([row[1]], pa.binary())], names=[*NAMES, "kind", "part", "text"])

        for ids, rows in slices(batches):
            out = []
            for doc_id, text in zip(ids, rows, strict=True):
                now = (doc_id, text, fingerprint(text))
                if before is None:
                    yield edge(2, now)
                else:
                    out.append(compare(*before, now[1], now[2]))
                before = now
            n = len(out)
            yield pa.RecordBatch.from_arrays([*_arrays(out), pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int64()), pa.nulls(n, pa.binary())], names=[*NAMES, "kind", "part", "text"])
        if before is not None:
            yield edge(1, before)

    def close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(_arrays([compare(row["doc_id"], row["text"], row["fingerprint"], row["after"], row["next_print"])]), names=NAMES)

    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = texts(docs).select("doc_id", "text", order[1].alias("h"), order[2].alias("n"))
    dealt = dealt.repartitionByRange(partitions(spark), order[0], "h", "n").sortWithinPartitions(order[0], "h", "n").select("doc_id", "text")
    out = written(dealt.mapInArrow(run, ", ".join([*RESULT, "kind int", "part long", "text binary"])))
    # As many rows as partitions come to the driver.
    parts = sorted(r["part"] for r in out.where("kind = 2").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part long, next_part long")
    heads = out.where("kind = 2").select(F.col("part").alias("next_part"), F.col("text").alias("after"), F.col("fingerprint").alias("next_print"))
    last = out.where("kind = 1").select("doc_id", "text", "fingerprint", "part").join(follows, "part").join(heads, "next_part")
    return out.where("kind = 0").select(*NAMES).unionByName(last.select("doc_id", "text", "fingerprint", "after", "next_print").mapInArrow(close, ", ".join(RESULT)))
