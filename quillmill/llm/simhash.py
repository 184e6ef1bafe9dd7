"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint bit is set if it is set in over half of a text's shingle hashes. Two fingerprints link if they
differ in at most three bits. Every fingerprint emits the variants within half that radius, one and a half: those
at distance 0 and 1, and of those at distance 2 the ones whose two flipped bits lie in the same half of the
fingerprint. Of any three differing bits two lie in one half, so a pair at distance 3 meets where one side flips
these two and the other side flips the third; and since such a pair has one fingerprint of odd weight and one of
even weight, only the odd ones need to emit distance 2.

Fingerprints that meet on a variant are at most 2 apart if both reached it by one flip or none ("near"), at most 3
if one did. So all that met on a variant with a near member are linked through that member: a bucket gives a
star, never all its pairs, and holds at most 1 + 64 + 992 distinct fingerprints whatever the data. Exact copies
share a fingerprint and are one node. Components are found on Spark, from the stars.

Variants travel as packed arrays, one binary row per batch and part: which flip each is, and the fingerprint it is of, once for all of its
variants in the row where there are two or more on average. So one takes two to ten bytes at 64 bits.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like any other; rows
repeated under one doc_id give a row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, components, partitions, slices, text_key, texts, written

#: Texts longer than this are split into words piece by piece.
PIECE = 1 << 22
#: Variants per part that a task sorts at once.
PART_ROWS = 3_000_000
#: Bytes of variants that a task writes, about.
TASK_BYTES = 32_000_000
#: Fingerprints whose variants a task holds at once.
BATCH = 4096
#: Rows of two longs up to which the side of a join is broadcast.
BROADCAST_ROWS = 2_000_000
#: Tables whose links are verified before those of the others.
FIRST_TABLES = 4
#: Bytes of shingle sets up to which they are broadcast to the pairs.
BROADCAST_BYTES = 32_000_000


def shingle_hashes(text: bytes, words: int, seed: int) -> Iterator[int]:
    """XXH64 of each run of so many words of the ASCII-lower-cased text; of the whole sequence if it is shorter."""
    digest = xxhash.xxh64_intdigest
    if len(text) <= PIECE:
        tokens = text.lower().split()
        if len(tokens) <= words:
            return iter([digest(b" ".join(tokens), seed)] if tokens else [])
        return (digest(x, seed) for x in map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))
    return _long_hashes(text, words, seed)


def _long_hashes(text: bytes, words: int, seed: int) -> Iterator[int]:
    last, rest, hashed = [], b"", 0
    for at in range(0, len(text), PIECE):
        piece = rest + text[at : at + PIECE].lower()
        cut = len(piece) if at + PIECE >= len(text) else max(piece.rfind(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1
        tokens, rest = last + piece[:cut].split(), piece[cut:]
        for x in map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)):
            hashed += 1
            yield xxhash.xxh64_intdigest(x, seed)
        last = tokens[max(0, len(tokens) - words + 1) :] if words > 1 else []
    if not hashed and last:
        yield xxhash.xxh64_intdigest(b" ".join(last), seed)


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """The hash of a further fingerprint word, from the first one's."""
    if word == 0:
        return h
    z = h + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(text: bytes, words: int = 3, seed: int = 42, longs: int = 1) -> tuple[np.ndarray, int]:
    """The fingerprint as so many unsigned longs, and the number of shingles."""
    counts, total, hashes = np.zeros((longs, 64), np.int64), 0, shingle_hashes(text, words, seed)
    while len(h := np.fromiter(islice(hashes, 1 << 15), np.uint64)):
        total += len(h)
        for k in range(longs):
            counts[k] += np.unpackbits(_mixed(h, k).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > total, axis=1, bitorder="little").view(np.uint64)[:, 0], total


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, longs: int = 1) -> DataFrame:
    """(doc_id, fp array<long>, shingles long), a row for each row of docs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in slices(batches):
            found = [fingerprint(x, words, seed, longs) for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x.view(np.int64).tolist() for x, _ in found], pa.list_(pa.int64())), pa.array([n for _, n in found], pa.int64())], names=["doc_id", "fp", "shingles"])

    return texts(docs).mapInArrow(run, "doc_id long, fp array<long>, shingles long")


def masks(bits: int, radius: int = 3) -> tuple[np.ndarray, int]:
    """The flips within half the radius: of no bit and one bit, then for radius 3 those of two bits within one half; how many of the former there are."""
    one = [1 << i for i in range(bits)]
    two = [one[i] | one[j] for half in (range(bits // 2), range(bits // 2, bits)) for i in half for j in half if i < j and radius == 3]
    return np.array([0, *one, *two], np.uint64), bits + 1


def packed_variants(tab: int, parts: int, flips: np.ndarray, at: np.ndarray, code: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """A row for each part of a table that variants fall in. at, code: for each variant the place of its word in the columns, and its flip; columns: the words and what travels with them."""
    out = columns["words"][at] ^ flips[code]
    part = ((_mixed(out.astype(np.uint64), tab + 1) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part * len(columns["words"]) + at, kind="stable")
    part, at, code = part[order], at[order], code[order]
    ends = np.searchsorted(part, np.arange(parts + 1))
    full = np.flatnonzero(np.diff(ends))
    once = len(flips) >= 2 * parts  # a word stands once in a row, with the number of its variants there
    first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (at[1:] != at[:-1])])) if once else np.arange(len(at))
    counts = np.diff(np.append(first, len(at))).astype(code.dtype) if once else code[:0]
    starts, held = np.searchsorted(first, ends), {c: x[at[first]] for c, x in columns.items()} | {"counts": counts}
    return pd.DataFrame({"tab": tab, "part": full, "codes": [code[ends[p] : ends[p + 1]].tobytes() for p in full], **{c: [x[starts[p] : starts[p + 1]].tobytes() for p in full] for c, x in held.items()}})


def unpacked_variants(frame: pd.DataFrame, flips: np.ndarray, code: type, **columns: type) -> list[np.ndarray]:
    """The variants of packed_variants() rows, their flips, and their columns, the words first, a value for each variant."""
    joined = lambda c, kind: np.frombuffer(b"".join(frame[c]), kind)
    codes, counts = joined("codes", code), joined("counts", code)
    held = [np.repeat(x, counts) if len(counts) else x for x in (joined(c, kind) for c, kind in columns.items())]
    return [held[0] ^ flips[codes], codes, *held]


def ball_links(prints: DataFrame, bits: int = 64, radius: int = 3) -> DataFrame:
    """(tab int, a long, b long, crowd boolean): a star for each variant on which distinct prints (tab int, fp long) of a table met; crowd says that more than these two met on one.

    With radius 2 the star's centre is a, the least of them. A star's members are not linked to each other: a caller that verifies links takes those of failed stars to bucket_pairs().
    """
    kind = np.uint64 if bits > 32 else np.uint32
    flips, near = masks(bits, radius)
    flips, small = flips.astype(kind), np.uint8 if len(flips) <= 256 else np.uint16
    prints = prints.select(F.col("tab").cast("int").alias("tab"), F.col("fp").cast("long").alias("fp")).distinct()
    prints = checkpointed(prints)
    tabs, most, every = prints.groupBy("tab").count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
    each = near + (len(flips) - near) / 2
    parts = partitions(prints.sparkSession, (most or 0) * each / PART_ROWS) // max(1, tabs) + 1
    # Few bytes become many here, so tasks are dealt by what they write.
    dealt = prints.repartition(partitions(prints.sparkSession, (every or 0) * each * (flips.itemsize + np.dtype(small).itemsize) / TASK_BYTES), "tab", "fp")

    def spread(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for tab, group in frame.groupby("tab"):
                values = group["fp"].to_numpy(np.int64).view(np.uint64).astype(kind)
                for start in range(0, len(values), BATCH):
                    v = values[start : start + BATCH]
                    odd = np.flatnonzero(np.bitwise_count(v) % 2 == 1)
                    at = np.concatenate([np.repeat(np.arange(len(v)), near), np.repeat(odd, len(flips) - near)])
                    code = np.concatenate([np.tile(np.arange(near, dtype=small), len(v)), np.tile(np.arange(near, len(flips), dtype=small), len(odd))])
                    yield packed_variants(tab, parts, flips, at, code, words=v)

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        v, code, _ = unpacked_variants(frame, flips, small, words=kind)
        order = np.argsort(v)
        v = v[order]
        same = np.concatenate([[False], v[1:] == v[:-1], [False]])
        met = same[1:] | same[:-1]  # on a variant that another print reached too
        v, code = v[met], code[order][met]
        origin, far = v ^ flips[code], code >= near
        order = np.lexsort((origin, far, v))  # a bucket's first row is its smallest near member, if it has one
        v, origin, far = v[order], origin[order], far[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, int)
        size = np.diff(np.append(first, len(v)))
        centre = np.repeat(first, size)
        use = ~far[centre] & (centre != np.arange(len(v)))
        a, b = np.sort(np.stack([origin[centre][use], origin[use]]), 0).astype(np.uint64)
        crowd = np.repeat(size > 2, size)[use]
        order = np.lexsort((~crowd, b, a))
        a, b, crowd = a[order], b[order], crowd[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
        return pd.DataFrame({"tab": int(key[0]), "a": a[new].view(np.int64), "b": b[new].view(np.int64), "crowd": crowd[new]})

    spreading = dealt.mapInPandas(spread, "tab int, part int, codes binary, words binary, counts binary")
    return spreading.repartition(parts * max(1, tabs), "tab", "part").groupBy("tab", "part").applyInPandas(meet, "tab int, a long, b long, crowd boolean").groupBy("tab", "a", "b").agg(F.max("crowd").alias("crowd"))


#: What every_variant() gives.
PACKED = "tab int, part int, codes binary, words binary, nodes binary, roots binary, counts binary"


def parts_of(held: DataFrame, variants: int) -> tuple[int, int]:
    """Parts of each table, and tables, of (tab, ...) with so many variants a row: as many parts in all as the session shuffles into, or more if the data ask for it, so that a task writes few rows for each table."""
    rows, tabs = held.agg(F.count("*"), F.count_distinct("tab")).first()
    return partitions(held.sparkSession, rows * variants * 4 / PART_ROWS) // max(1, tabs) + 1, max(1, tabs)


def every_variant(tab: int, parts: int, flips: np.ndarray, rows: pd.DataFrame) -> pd.DataFrame:
    """packed_variants() of all flips of a table's (word, node, root)."""
    at, code = np.repeat(np.arange(len(rows)), len(flips)), np.tile(np.arange(len(flips), dtype=np.uint8), len(rows))
    return packed_variants(tab, parts, flips, at, code, words=rows["word"].to_numpy(np.int64).astype(np.uint32), nodes=rows["node"].to_numpy(np.int64), roots=rows["root"].to_numpy(np.int64))


def bucket_pairs(held: DataFrame, low: int, high: int) -> DataFrame:
    """(a long, b long): of the (node, root) with 32-bit words (tab, word) that meet on a variant within one flip, the pairs of unlike roots that hold
    one of the bucket's members from place low to below high, in order of node; a row of nulls says that buckets have pairs of unlike roots beyond."""
    flips, near = masks(32, 2)
    flips = flips.astype(np.uint32)
    parts, tabs = parts_of(held, near)

    def spread(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for tab, group in frame.groupby("tab"):
                for start in range(0, len(group), BATCH):
                    yield every_variant(tab, parts, flips, group.iloc[start : start + BATCH])

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        v, _, _, node, root = unpacked_variants(frame, flips, np.uint8, words=np.uint32, nodes=np.int64, roots=np.int64)
        order = np.lexsort((node, v))
        v, node, root = v[order], node[order], root[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        mixed = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
        size = np.diff(np.append(first, len(v)))
        start = np.repeat(first, size)
        live, found = np.flatnonzero(np.repeat(mixed, size)), [np.zeros((0, 2), np.int64)]
        for place in range(low, high):
            live = live[live - start[live] > place]
            if not len(live):
                break
            centre = start[live] + place
            use = root[centre] != root[live]
            found.append(np.unique(np.stack([node[centre[use]], node[live[use]]], 1), axis=0))
        pairs = pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"], dtype="Int64")
        live = live[live - start[live] >= high]
        cuts = np.flatnonzero(np.concatenate([[True], start[live][1:] != start[live][:-1]])) if len(live) else []
        beyond = len(live) and (np.minimum.reduceat(root[live], cuts) != np.maximum.reduceat(root[live], cuts)).any()
        return pd.concat([pairs, pd.DataFrame({"a": [None], "b": [None]}, dtype="Int64")]) if beyond else pairs

    spreading = held.select("tab", "word", "node", "root").mapInPandas(spread, PACKED)
    return spreading.repartition(parts * tabs, "tab", "part").groupBy("tab", "part").applyInPandas(meet, "a long, b long").distinct()


def alike(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float, columns: int = 8192) -> np.ndarray:
    """Which pairs of sets, by their numbers, are at least so similar: shared elements as bits, so many at a time."""
    size = np.array([len(x) for x in sets])
    every, n = np.unique(np.concatenate(sets), return_counts=True)
    every, common = every[n > 1], np.zeros(len(i), np.int64)
    for at in range(0, len(every), columns):
        part = every[at : at + columns]
        bits = np.packbits(np.stack([np.isin(part, x, assume_unique=True) for x in sets]), axis=1)
        for k in range(0, len(i), 1 << 14):
            common[k : k + (1 << 14)] += np.bitwise_count(bits[i[k : k + (1 << 14)]] & bits[j[k : k + (1 << 14)]]).sum(1, dtype=np.int64)
    return common >= similarity * (size[i] + size[j] - common) - 1e-9


def bucket_links(held: DataFrame, sets: tuple[np.ndarray, np.ndarray, np.ndarray], similarity: float) -> DataFrame:
    """(a long, b long): of the (node, root) with 32-bit words (tab, word) that meet on a variant within one flip, the pairs of unlike roots whose sets are at least so similar. sets: packed_sets() of all
    nodes, of a bounded size, which go to every task: so the pairs are compared where they meet, and only links leave. A pair is compared in one of the buckets that it shares in a table."""
    flips = masks(32, 2)[0].astype(np.uint32)
    parts, tabs = parts_of(held, len(flips))
    known = held.sparkSession.sparkContext.broadcast(sets)

    def spread(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for tab, rows in frame.groupby("tab"):
                yield every_variant(tab, parts, flips, rows)

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        nodes, ends_of, elements = known.value
        v, _, word, node, root = unpacked_variants(frame, flips, np.uint8, words=np.uint32, nodes=np.int64, roots=np.int64)
        order = np.lexsort((node, v))
        v, word, node, root = v[order], word[order], node[order], root[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        ends = np.append(first[1:], len(v))
        mixed = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
        found = [np.zeros((0, 2), np.int64)]
        for lo, hi in zip(first[mixed], ends[mixed], strict=True):
            w, r, where = word[lo:hi], root[lo:hi], v[lo]
            sets = [elements[ends_of[k] : ends_of[k + 1]] for k in np.searchsorted(nodes, node[lo:hi])]
            size = np.array([len(x) for x in sets])
            for at in range(0, hi - lo, 256):
                i, j = np.nonzero((r[at : at + 256, None] != r[None, :]) & (np.arange(at, min(at + 256, hi - lo))[:, None] < np.arange(hi - lo)[None, :]))
                i += at
                apart = np.bitwise_count(w[i] ^ w[j])
                # Of the buckets that two words share, one compares them: the word's own, the lesser word's, or the lesser of the two between them.
                here = np.where(apart == 2, where < (w[i] ^ w[j] ^ where), where == np.minimum(w[i], w[j]))
                here &= np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-9
                i, j = i[here], j[here]
                if len(i):
                    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
                    ok = alike([sets[u] for u in used], place[: len(i)], place[len(i) :], similarity)
                    found.append(np.stack([node[lo:hi][i[ok]], node[lo:hi][j[ok]]], 1))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    spreading = held.select("tab", "word", "node", "root").mapInPandas(spread, PACKED)
    return spreading.repartition(parts * tabs, "tab", "part").groupBy("tab", "part").applyInPandas(meet, "a long, b long").distinct()


def rooted(df: DataFrame, found: DataFrame, node: str, root: str) -> DataFrame:
    """df with the root of a column's node: the node itself where no link has it."""
    return df.join(found.select(F.col("node").alias(node), F.col("root").alias("_root")), node, "left").withColumn(root, F.coalesce("_root", node)).drop("_root")


def linked(held: DataFrame, verified: Callable[[DataFrame], DataFrame], close: Callable[[DataFrame], DataFrame] = lambda pairs: pairs, inside: Callable[[DataFrame], DataFrame | None] = lambda opened: None) -> DataFrame:
    """(node, root): components of the pairs of nodes that meet and are verified. held: (tab, word, node), 32-bit words; verified: (a, b) to those that hold; close: (a, b) to those that lie
    so near each other that what is linked with one of them may be linked with the other, where that can be told; inside: (a, b) of those that hold among all that meet of (tab, word,
    node, root) and are of unlike root, or None where these are too many for it.

    First each bucket of words is linked by its star, and the holders of a word by the least: those of FIRST_TABLES tables, and then of the others what is still of unlike root. A member that fails may still belong to another one: to one that failed too and has
    another root, or to one that holds, if it is close to the centre. Where neither is so, or no third node is there, nothing is left to compare. Of other stars all nodes are
    compared: by inside, or else each bucket's first member with all others of unlike root, then the next ones, more of them in each round, until no bucket
    has a pair of unlike roots that was not verified. So all met pairs that could join anything are, whatever a star's centre is like.
    """
    links = checkpointed(ball_links(held.select("tab", F.col("word").alias("fp")), bits=32, radius=2))
    one = checkpointed(held.groupBy("tab", "word").agg(F.min("node").alias("least"), F.count("*").alias("n")))
    # Words that several nodes share hang on one of them; it comes first in each pair, as a bucket's centre does.
    shared = held.join(one.where("n > 1"), ["tab", "word"]).where("node <> least").select("tab", "word", F.col("word").alias("b_word"), F.col("least").alias("a"), F.col("node").alias("b"), (F.col("n") > 2).alias("third"))
    at = lambda side, word: one.select("tab", F.col("word").alias(word), F.col("least").alias(side), F.col("n").alias(f"{side}_n"))
    across = links.select("tab", F.col("a").alias("word"), F.col("b").alias("b_word"), "crowd").join(at("a", "word"), ["tab", "word"]).join(at("b", "b_word"), ["tab", "b_word"])
    across = across.select("tab", "word", "b_word", "a", "b", (F.col("crowd") | (F.col("a_n") > 1) | (F.col("b_n") > 1)).alias("third"))
    met = checkpointed(shared.unionByName(across).where("a <> b"))
    pair = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    apart = lambda df, found: checkpointed(rooted(rooted(df, found, "a", "a_root"), found, "b", "b_root").where("a_root <> b_root"))
    links_of = lambda found: found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    # A few tables join most of a group; what the others link of one root needs no look at fingerprints or sets.
    tried = checkpointed(pair(met.where(F.col("tab") < FIRST_TABLES)))
    found = checkpointed(components(verified(tried)))
    open_met = apart(met, found)
    later = checkpointed(pair(open_met.where(F.col("tab") >= FIRST_TABLES)).join(tried, ["a", "b"], "left_anti"))
    good = checkpointed(verified(later))
    if not good.isEmpty():
        found = checkpointed(components(good.unionByName(links_of(found))))
    tried = tried.unionByName(later)
    failed = apart(open_met.where("third").drop("a_root", "b_root"), found)
    near = close(failed.select("a", "b").distinct()).withColumn("close", F.lit(True))
    stars = failed.join(near, ["a", "b"], "left").groupBy("tab", "word").agg(F.max(F.coalesce("close", F.lit(False))).alias("close"), F.min("b_root").alias("lo"), F.max("b_root").alias("hi"))
    bad = written(stars.where("close or lo <> hi").select("tab", "word"))
    if bad.isEmpty():
        return found
    # All members of a bucket are linked to its centre.
    members = written(bad.join(met.where("third").select("tab", "word", "b_word"), ["tab", "word"]).select("tab", F.col("b_word").alias("word")).distinct())
    open_ = checkpointed(held.join(bad.unionByName(members).distinct(), ["tab", "word"]))
    if (more := inside(rooted(open_, found, "node", "root"))) is not None:
        more = checkpointed(more)
        return found if more.isEmpty() else components(more.unionByName(links_of(found)))
    low, high = 0, 2
    while True:
        more = checkpointed(bucket_pairs(rooted(open_, found, "node", "root"), low, high))
        fresh = pair(more.where("a is not null")).join(tried, ["a", "b"], "left_anti")
        joined = checkpointed(verified(fresh))
        if not joined.isEmpty():
            # What is found stands for the links before it.
            found = checkpointed(components(joined.unionByName(links_of(found))))
        if more.where("a is null").isEmpty():
            return found
        low, high = high, high * 4


def simhash_components(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id): 64-bit fingerprints linked at 3 or fewer differing bits; the smallest doc_id reachable."""
    prints = checkpointed(fingerprints(docs, words, seed).select("doc_id", F.col("fp")[0].alias("fp")))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(ball_links(nodes.select(F.lit(0).alias("tab"), "fp")).select("a", "b"))
    placed = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    least = placed.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    placed = placed.join(least, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(placed, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: bytes, words: int, seed: int) -> np.ndarray:
    """The distinct shingle hashes in order."""
    return np.unique(np.fromiter(shingle_hashes(text, words, seed), np.uint64))


def set_prints(docs: DataFrame, words: int, seed: int, longs: int) -> DataFrame:
    """(doc_id, node long, fp array<long>, shingles long): a row for each row of docs; node is a hash of the set of shingles, which fp and shingles are of too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in slices(batches):
            found = []
            for x in rows:
                h = shingle_set(x, words, seed)
                counts = np.zeros((longs, 64), np.int64)
                for at in range(0, len(h), 1 << 15):
                    for k in range(longs):
                        counts[k] += np.unpackbits(_mixed(h[at : at + (1 << 15)], k).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
                bits = counts * 2 > len(h)
                if len(h) in (2, 4, 6, 8):
                    # So few shingles tie often, and were ties zero, unlike sets would meet by their many zeros. Two sets of one such size are equal or under 0.8.
                    ties = np.unpackbits(np.concatenate([_mixed(h[:1], longs + k) for k in range(longs)]).view(np.uint8).reshape(longs, 8), axis=1, bitorder="little")
                    bits = np.where(counts * 2 == len(h), ties == 1, bits)
                found.append((np.packbits(bits, axis=1, bitorder="little").view(np.int64)[:, 0].tolist(), len(h), xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[2] for x in found], pa.int64()), pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.int64())], names=["doc_id", "node", "fp", "shingles"])

    return docs.mapInArrow(run, "doc_id long, node long, fp array<long>, shingles long")


def shingle_sets(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(node, hashes array<long>) of (node, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in slices(batches):
            sets = [shingle_set(x, words, seed).view(np.int64) for x in rows]
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.LargeListArray.from_arrays(ends, np.concatenate(sets)).cast(pa.list_(pa.int64()))], names=["node", "hashes"])

    return docs.mapInArrow(run, "node long, hashes array<long>")


def packed_sets(sets: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes in order, ends, elements) of (node, hashes): the sets one behind another, 8 bytes an element; as rows of Python numbers they would take five times that."""
    found = sets.select("node", "hashes").orderBy("node").toArrow()
    hashes = found.column("hashes")
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(hashes).to_numpy())]).astype(np.int64)
    return found.column("node").to_numpy(), ends, pc.list_flatten(hashes).to_numpy().view(np.uint64)


def similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of (a, b, a_set, b_set) whose sets' similarity is at least so much. The slack is for rounding alone: 0.8 * 10 is more than 8 in no way that counts."""
    common = F.size(F.array_intersect("a_set", "b_set"))
    return pairs.where(common >= similarity * (F.size("a_set") + F.size("b_set") - common) - 1e-9).select("a", "b")


def near_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, tables: int = 28, seed: int = 42) -> DataFrame:
    """(row_key, root): texts with a word, by their keys, linked where the similarity of their sets of shingles is at least so much. docs: (row_key long, text), one text for a key.

    Fingerprints of 32 * tables bits, of the distinct shingles, are searched: each of their words of 32 bits by the same ball hashing, with
    radius 2, for which every word emits its variants at distance 0 and 1. A pair that meets in any word is verified exactly, on all distinct
    shingles by 64-bit hashes. So no pair below the similarity links, and of those at least that high the ones that meet do: at similarity 0.8 a
    word's chance is 0.12, with 28 words a pair's is 0.97; at 0.85 it is 0.996. Equal sets always link.
    """
    prints = checkpointed(set_prints(texts(docs, "row_key"), words, seed, tables // 2).where("shingles > 0"))
    nodes = checkpointed(prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("fp").alias("fp"), F.first("shingles").alias("n")))
    cut = F.expr(f"transform(sequence(0, {tables - 1}), t -> struct(t as tab, shiftrightunsigned(fp[cast(t div 2 as int)], cast(t % 2 * 32 as int)) & 4294967295L as word))")
    held = checkpointed(nodes.select("node", F.explode(cut).alias("x")).select("node", "x.tab", "x.word"))
    full = lambda side: nodes.select(F.col("node").alias(side), F.col("first").alias(f"{side}_first"), F.col("fp").alias(f"{side}_fp"), F.col("n").alias(f"{side}_n"))
    differ = F.expr("aggregate(zip_with(a_fp, b_fp, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")

    def apart(limit: float) -> Column:
        """Certainly less similar than that: by sizes alone, or, for sets large enough for such an estimate, by six standard deviations over what pairs at the limit differ in."""
        angle = F.acos(F.least(F.lit(1.0), limit / (1 + limit) * (F.col("a_n") + F.col("b_n")) / F.sqrt(F.col("a_n") * F.col("b_n")))) / np.pi
        far = (F.least("a_n", "b_n") >= 64) & (differ > 32 * tables * angle + 6 * F.sqrt(32 * tables * angle * (1 - angle)) + 6)
        return far | (F.least("a_n", "b_n") < limit * F.greatest("a_n", "b_n") - 1e-9)

    def close(pairs: DataFrame) -> DataFrame:
        """One less similarity is a metric: what is linked with one of a pair, and so at most 1 - similarity from it, is linked with the other only if the two are at most twice that apart."""
        return pairs.join(full("a"), "a").join(full("b"), "b").where(~apart(2 * similarity - 1)).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        likely = checkpointed(pairs.join(full("a"), "a").join(full("b"), "b").where(~apart(similarity)).select("a", "b", "a_first", "b_first"))
        needed = likely.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a_first").alias("first")), F.struct(F.col("b").alias("node"), F.col("b_first").alias("first")))).alias("x")).select("x.*").distinct()
        sets, size = sets_of(needed)
        sets = F.broadcast(sets) if size <= BROADCAST_BYTES else sets
        side = lambda s: sets.select(F.col("node").alias(s), F.col("hashes").alias(f"{s}_set"))
        return similar(likely.select("a", "b").join(side("a"), "a").join(side("b"), "b"), similarity)

    def sets_of(needed: DataFrame) -> tuple[DataFrame, int]:
        """(node, hashes) of (node, first), and their bytes."""
        needed = checkpointed(needed)
        needed = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
        held_texts = texts(docs, "row_key").join(needed, F.col("doc_id") == F.col("first")).select("node", "text").dropDuplicates(["node"])
        sets = checkpointed(shingle_sets(held_texts, words, seed))
        return sets, 8 * (sets.agg(F.sum(F.size("hashes") + F.lit(4))).first()[0] or 0)

    def inside(opened: DataFrame) -> DataFrame | None:
        needed = checkpointed(opened.select("node").distinct()).join(nodes.select("node", F.col("first"), "n"), "node")
        if 8 * (needed.agg(F.sum(F.col("n") + 4)).first()[0] or 0) > BROADCAST_BYTES:
            return None
        return bucket_links(opened, packed_sets(sets_of(needed.select("node", "first"))[0]), similarity)

    found = linked(held, verified, close, inside)
    return rooted(prints.select(F.col("doc_id").alias("row_key"), "node"), found, "node", "root").select("row_key", "root").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, tables: int = 28, seed: int = 42) -> DataFrame:
    """(doc_id, component_id): near_groups by doc_id, each named by its smallest; a row for each row of docs. Rows without a word, or without both an id and an equal text with one, stand for themselves."""
    keyed = texts(docs).withColumn("row_key", text_key())
    placed = keyed.select("doc_id", "row_key").join(near_groups(keyed, words, similarity, tables, seed), "row_key", "left")
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select("doc_id", F.coalesce("least", "doc_id").alias("component_id"))


def near_dedup(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents without those that are near-duplicates of a smaller doc_id in their group; one row for each doc_id and text that stay.

    Rows are told apart by doc_id and text, so texts under one doc_id and texts without one are documents of their own; those without one come last in their group.

    A document with fewer words than a shingle counts as one shingle, so it goes only for an equal one.
    Documents without any word stay: there is nothing in them that another could repeat.
    """
    # The rows travel in one column, so that no name of theirs can clash.
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("text"), F.xxhash64(F.col("doc_id"), text_key()).alias("key"), text_key().alias("row_key"))
    ids = checkpointed(keyed.select(F.col("id").cast("long").alias("id"), "key", "row_key").distinct())
    rows = ids.join(near_groups(docs.select(text_key().alias("row_key"), "text"), words, similarity), "row_key")
    kept = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("kept")).select("root", F.col("kept")["key"].alias("kept"))
    gone = rows.join(kept, "root").where("key <> kept").select("key").distinct()
    # A row without an id and any word is no other's repetition: it gets a number of its own.
    alone = F.when(F.col("id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^ \t\n\x0B\f\r]"), F.monotonically_increasing_id())
    left = keyed.withColumn("alone", alone).join(gone, "key", "left_anti")
    return left.dropDuplicates(["key", "alone"]).select("row.*")
