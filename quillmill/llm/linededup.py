"""Line-level deduplication with DataFrame operations only.

Each text is split at newlines. A line's key is the line stripped of ASCII white space and with A-Z lower-cased. Keys
of at least min_length code points are hashed to 128 bits, exploded with their position and counted by distinct document; a key found in
at least min_docs documents loses all its lines, except in the largest doc_id that holds it. The positions that a text loses are joined to it,
and what stays is put together by position, in time that grows with the number of lines. Texts are shuffled once, to meet what they lose; the counting moves hashes
and positions alone. Keys held by very many lines are told apart first: at most HOT_KEYS keys can have more than a
HOT_KEYS-th of all lines, so these are broadcast, and no key that is joined by shuffle has more lines than that.

Defined results: a null or empty text is one empty line; a text that loses all lines becomes empty; rows repeated under one
doc_id count as one document and each lose their lines of the same keys; rows with a null doc_id are no document that could be counted or keep a line, and lose none;
extra columns, whatever their names, are kept in drop_lines and ignored in the counts, but for n_lines and n_dropped, which it sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_SPACE, ASCII_UPPER, checkpointed


#: Keys that may be broadcast, of 24 bytes each.
HOT_KEYS = 10_000


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(ASCII_SPACE))
    # lower() is cheap and right for a line of ASCII alone; in others only A-Z may change.
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(bare)).otherwise(F.translate(bare, ASCII_UPPER, ASCII_LOWER))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed(text: Column, min_length: int) -> Column:
    """For each line, by position, two 64-bit hashes of its key; null where the key is too short to count."""
    return F.transform(F.transform(lines(text), line_key), lambda k: F.when(F.char_length(k) >= min_length, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("second"), k).alias("h2"))))


def of_text() -> Column:
    """What tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def held_lines(docs: DataFrame, min_length: int = 20) -> DataFrame:
    """(doc_id, of, pos, h1, h2): the lines long enough to count; read twice, so written once."""
    # of is computed before the lines are exploded, else it would be for each of them.
    held = docs.select("doc_id", of_text().alias("of"), "text").select("doc_id", "of", F.posexplode(hashed(F.col("text"), min_length)).alias("pos", "h"))
    return checkpointed(held.where("h is not null").select("doc_id", "of", "pos", "h.h1", "h.h2"))


def repeated_lines(held: DataFrame, min_docs: int = 3) -> DataFrame:
    """(h1, h2, keeper, n_rows): keys found in enough documents, the largest doc_id among these, and how many lines have it."""
    return (
        held.groupBy("h1", "h2")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"), F.count("*").alias("n_rows"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper", "n_rows")
    )


def without(text: Column, lost: Column) -> Column:
    """The lines of text but those at the positions lost. The lines are bound once, so each position is a look-up."""
    of = F.struct(lines(text).alias("lines"), lost.alias("lost"))
    keep = lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["lost"]), lambda p: x["lines"][p])
    return F.transform(F.array(of), keep)[0]


def drop_lines(docs: DataFrame, min_length: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with text reduced, and with n_lines and n_dropped; the other columns stay as they are."""
    held = held_lines(docs.select("doc_id", "text"), min_length)
    repeated = checkpointed(repeated_lines(held, min_docs))
    most = max(1, held.count() // HOT_KEYS)
    hot = F.broadcast(repeated.where(F.col("n_rows") > most).select("h1", "h2", "keeper"))
    rest = held.join(hot, ["h1", "h2"], "left_anti").join(repeated.where(F.col("n_rows") <= most).select("h1", "h2", "keeper"), ["h1", "h2"])
    lost = held.join(hot, ["h1", "h2"]).unionByName(rest).where("doc_id <> keeper")
    lost = lost.groupBy("doc_id", "of").agg(F.collect_set("pos").alias("lost"))
    # The rows travel in one column, so that no name of theirs can clash.
    joined = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), of_text().alias("text_of")).join(lost, (F.col("id") == F.col("doc_id")) & (F.col("text_of") == F.col("of")), "left")
    text, some = F.col("row")["text"], F.col("lost").isNotNull()
    of = {
        "text": F.when(some, F.array_join(without(text, F.col("lost")), "\n")).otherwise(F.coalesce(text, F.lit(""))),
        "n_lines": F.size(lines(text)).cast("long"),
        "n_dropped": F.when(some, F.size("lost")).otherwise(0).cast("long"),
    }
    return joined.select(*(of.get(c, F.col("row")[c]).alias(c) for c in dict.fromkeys([*docs.columns, *of])))
