"""Merkle fixity audit of WARC replicas, with DataFrame operations.

A record is known by its file, offset, length and the SHA-256 digest of its bytes, and by a name that survives a move, as its header gives one. Records hash into leaves by ordered offset
ranges (LEAF_BYTES each), leaves into parents of FANOUT neighbouring ranges, up to a root per file. Two replicas, each indexed from its own bytes, are compared root by root; only children of nodes that
differ are compared next, so that a sound file costs one comparison. A record that is lost or longer than it was moves all after it, and the leaves from there on differ; so
in the leaves that differ records are first matched by name and digest wherever they lie, which clears what has only moved, then by name, which tells the changed ones. What is left is missing or
surplus. Without names a record's offset is its name: then a replica is one whose records keep their places.

A node has at most FANOUT children and a leaf at most the records that LEAF_BYTES hold, so no group grows with the data; records of one name in one file are numbered together, and a file is bounded.

Defined results: a null url or html is an empty one; of records repeated under one name as many as have equal digests match, and the others are matched in the order of their offsets; a null name is the offset; an empty replica makes
each record of the other missing or surplus; two empty ones give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

LEAF_BYTES, FANOUT = 65_536, 16


def warc_record(url: Column, html: Column) -> Column:
    """The bytes of a response record, as text."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def warc_index(records: DataFrame, file: Column, order: list[str], record: Column, name: Column) -> DataFrame:
    """(file, offset, length, digest, name): records lie in their file one after the other, by the columns of order and their digest. Only lengths, digests and names meet in a file's window; a file holds a bounded number of records."""
    keys = [F.col(c).alias(f"order{k}") for k, c in enumerate(order)]
    held = records.select(*keys, file.cast("string").alias("file"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest"), name.cast("string").alias("name"))
    before = Window.partitionBy("file").orderBy(*(f"order{k}" for k in range(len(order))), "digest").rowsBetween(Window.unboundedPreceding, -1)
    return held.select("file", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"), "length", "digest", "name")


def tree(records: DataFrame, leaf_bytes: int, fanout: int, levels: int) -> DataFrame:
    """(file, level, node, hash) of all levels; level 0 are leaves, and at the last level a file has one node."""
    entry = F.struct(F.col("offset"), F.concat_ws(":", "offset", "length", "digest").alias("line"))
    level = records.groupBy("file", F.floor(F.col("offset") / leaf_bytes).alias("node")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["line"]), "\n"), 256).alias("hash"))
    level = out = checkpointed(level.withColumn("level", F.lit(0)))
    for k in range(1, levels):
        child = F.struct("node", F.concat_ws(":", "node", "hash").alias("line"))
        level = level.groupBy("file", F.floor(F.col("node") / fanout).alias("up")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda x: x["line"]), "\n"), 256).alias("hash")).select("file", F.col("up").alias("node"), "hash", F.lit(k).alias("level"))
        out = out.unionByName(level)
    return checkpointed(out)


def audit(a: DataFrame, b: DataFrame, leaf_bytes: int = LEAF_BYTES, fanout: int = FANOUT) -> DataFrame:
    """(file, name, offset, length, status, digest_a, digest_b, offset_b): status changed, missing (from b) or surplus (in b); offset and length are a's, a surplus record's are b's."""
    named = lambda x: F.coalesce(F.col("name").cast("string") if "name" in x.columns else F.lit(None).cast("string"), F.col("offset").cast("string")).alias("name")
    a, b = (checkpointed(x.select(F.col("file").cast("string").alias("file"), F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length"), "digest", named(x))) for x in (a, b))
    most = max(x.agg(F.max("offset")).first()[0] or 0 for x in (a, b)) // leaf_bytes
    levels = 1
    while most:
        most, levels = most // fanout, levels + 1
    left, right = tree(a, leaf_bytes, fanout, levels), tree(b, leaf_bytes, fanout, levels)
    bad = None
    for k in range(levels - 1, -1, -1):
        x, y = (t.where(F.col("level") == k).select("file", "node", F.col("hash").alias(n)) for t, n in ((left, "x"), (right, "y")))
        if bad is not None:
            above = bad.select("file", F.col("node").alias("up"))
            x, y = (t.withColumn("up", F.floor(F.col("node") / fanout)).join(above, ["file", "up"], "left_semi").drop("up") for t in (x, y))
        # Read by the next level from both sides: written once, so that the plan does not double with each level.
        bad = checkpointed(x.join(y, ["file", "node"], "full").where(~F.col("x").eqNullSafe(F.col("y"))).select("file", "node"))

    def told(records: DataFrame) -> DataFrame:
        """Records of leaves that differ, equal ones numbered."""
        inside = records.withColumn("node", F.floor(F.col("offset") / leaf_bytes)).join(bad, ["file", "node"], "left_semi").drop("node")
        return checkpointed(inside.withColumn("k", F.row_number().over(Window.partitionBy("file", "name", "digest").orderBy("offset"))))

    def left_of(one: DataFrame, other: DataFrame, side: str) -> DataFrame:
        """What has no equal on the other side, numbered by name."""
        same = other.select("file", "name", F.col("digest").alias("d"), "k")
        alone = one.join(same, (one["file"] == same["file"]) & (one["name"] == same["name"]) & one["digest"].eqNullSafe(same["d"]) & (one["k"] == same["k"]), "left_anti")
        nth = F.row_number().over(Window.partitionBy("file", "name").orderBy("offset"))
        return alone.select("file", "name", nth.alias("nth"), *(F.col(c).alias(f"{c}_{side}") for c in ("offset", "length", "digest")), F.lit(True).alias(f"in_{side}"))

    x, y = told(a), told(b)
    both = left_of(x, y, "a").join(left_of(y, x, "b"), ["file", "name", "nth"], "full")
    status = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "surplus").otherwise("changed")
    return both.select("file", "name", F.coalesce("offset_a", "offset_b").alias("offset"), F.coalesce("length_a", "length_b").alias("length"), status.alias("status"), "digest_a", "digest_b", "offset_b")
