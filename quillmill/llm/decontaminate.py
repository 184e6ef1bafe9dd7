"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and runs of white space become one blank. An item of m characters tolerates
floor(budget * m) edits and is split into one piece more than that; where the item occurs within its budget, at least one
piece occurs unchanged. All pieces of a block of items are looked up in one pass over each whole text (Aho-Corasick), and a hit puts the
item on a diagonal. Halving the list of pieces again and again gives a tree, and the same principle holds in it: on the way from some
unchanged piece to the whole item, each stretch of p pieces has less than p edits. So a hit is first verified on
small stretches, by Myers' bit-parallel distance, and given up at the first that fails, which loses nothing. Hits that get through and
lie on neighbouring diagonals share a window, in which the same distance finds the item's best occurrence. Documents never meet each other, so neither copies nor a hot source gather anywhere.

Items are taken in blocks of at most about BLOCK_CHARS characters, by hash, and a block is broadcast; a benchmark of any size
is so many passes, each with a bounded automaton.

Defined results: null and empty texts match nothing; null or blank items match nothing; items shorter than
1 / budget characters must occur exactly; a pair that several rows repeat is reported once, at its best; no items, no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_key, texts

BLOCK_CHARS = 1_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


class Pattern:
    """Myers' bit-parallel approximate search of one string."""

    def __init__(self, item: str) -> None:
        self.m = len(item)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(item):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def distances(self, text: str, anchored: bool = False) -> Iterator[int]:
        """After each character: the least distance of the item to a stretch that ends there (anchored: that begins the text)."""
        mask, high, get = (1 << self.m) - 1, 1 << self.m - 1, self.bits.get
        plus, minus, score, first = mask, 0, self.m, int(anchored)
        for c in text:
            same = get(c, 0)
            down = same | minus
            flat = ((same & plus) + plus ^ plus) | same
            up, less = minus | ~(flat | plus) & mask, plus & flat
            if up & high:
                score += 1
            elif less & high:
                score -= 1
            up = (up << 1 | first) & mask
            plus, minus = (less << 1 | ~(down | up)) & mask, up & down
            yield score


def occurrence(item: str, pattern: Pattern, text: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best occurrence within so many edits, the first and then shortest of these; or None."""
    best, end = most + 1, -1
    for i, d in enumerate(pattern.distances(text)):
        if d < best:
            best, end = d, i + 1
    if end < 0:
        return None
    for k, d in enumerate(Pattern(item[::-1]).distances(text[:end][::-1], anchored=True)):
        if d == best:
            return best, end - k - 1, end
    return best, end, end


def cut(item: str, budget: float) -> tuple[int, list[tuple[int, str]]]:
    """The edits tolerated, and the pieces with their places."""
    edits = int(budget * len(item))
    ends = [round(i * len(item) / (edits + 1)) for i in range(edits + 2)]
    return edits, [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def stretches(item: str, parts: list[tuple[int, str]]) -> list[list[tuple[int, int, int, Pattern]]]:
    """For each piece, the stretches of two pieces and more that hold it, smallest first, without the whole: begin, end, edits, pattern."""
    out: list[list[tuple[int, int, int, Pattern]]] = [[] for _ in parts]
    ends = [at for at, _ in parts] + [len(item)]

    def halve(lo: int, hi: int) -> None:
        if hi - lo > 1:
            for a, b in ((lo, (lo + hi) // 2), ((lo + hi) // 2, hi)):
                halve(a, b)
                if b - a > 1:
                    node = (ends[a], ends[b], b - a - 1, Pattern(item[ends[a] : ends[b]]))
                    for i in range(a, b):
                        out[i].append(node)

    halve(0, len(parts))
    return out


class Matcher:
    def __init__(self, items: list[tuple[int, str]], budget: float) -> None:
        import ahocorasick

        self.items, found = [], {}
        for item_id, text in items:
            item = normal(text)
            edits, parts = cut(item, budget)
            for i, (at, part) in enumerate(parts):
                found.setdefault(part, []).append((len(self.items), at, i))
            self.items.append((item_id, item, Pattern(item), edits, stretches(item, parts)))
        self.automaton = ahocorasick.Automaton()
        for part, places in found.items():
            self.automaton.add_word(part, (len(part), places))
        self.automaton.make_automaton()

    def holds(self, text: str, diagonal: int, above: list[tuple[int, int, int, Pattern]]) -> bool:
        return all(min(pattern.distances(text[max(0, diagonal + a - e) : max(0, diagonal + b + e)]), default=e + 1) <= e for a, b, e, pattern in above)

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of each item's best occurrence, places in the normalised text."""
        text = normal(text)
        diagonals: dict[int, set[int]] = {}
        for end, (n, places) in self.automaton.iter(text):
            for k, at, i in places:
                diagonal = end + 1 - n - at
                if diagonal not in diagonals.get(k, ()) and self.holds(text, diagonal, self.items[k][4][i]):
                    diagonals.setdefault(k, set()).add(diagonal)
        for k, begins in diagonals.items():
            item_id, item, pattern, edits, _ = self.items[k]
            windows: list[list[int]] = []
            for b in sorted(begins):
                lo, hi = max(0, b - edits), b + len(item) + edits
                if windows and lo <= windows[-1][1] and hi - windows[-1][0] <= 8 * len(item):
                    windows[-1][1] = hi
                else:
                    windows.append([lo, hi])
            best = None
            for lo, hi in windows:
                if (o := occurrence(item, pattern, text[lo:hi], edits)) and (best is None or o[0] < best[0]):
                    best = (o[0], o[1] + lo, o[2] + lo)
                if best and not best[0]:
                    break
            if best:
                yield (item_id, *best)


def contaminated(docs: DataFrame, benchmark: DataFrame, budget: float = 0.1) -> DataFrame:
    """(doc_id, item_id, distance int, start int, end int): each item's best occurrence in each document, within its edit budget."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("trim(text) <> ''").distinct()
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_CHARS))
    rows, out = texts(docs), None
    for block in range(blocks):
        # A block holds about BLOCK_CHARS characters however large the benchmark is.
        block_items = [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()]
        held = docs.sparkSession.sparkContext.broadcast([(i, t) for i, t in block_items if normal(t)])

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, budget)
            if not matcher.items:
                return
            for ids, part in slices(batches):
                found = [(i, *m) for i, x in zip(ids, part, strict=True) for m in matcher.matches(x.decode("utf-8", "replace"))]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64() if k < 2 else pa.int32()) for k in range(5)], names=["doc_id", "item_id", "distance", "start", "end"])

        hits = rows.mapInArrow(run, "doc_id long, item_id long, distance int, start int, end int")
        out = hits if out is None else out.unionByName(hits)
    return out.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start", "end")).alias("m")).select("doc_id", "item_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, budget: float = 0.1) -> DataFrame:
    """The rows of docs in which no item occurs, with all their columns."""
    bad = contaminated(docs.select(text_key().alias("doc_id"), "text"), benchmark, budget).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, text_key() == bad["_bad"], "left_anti")
