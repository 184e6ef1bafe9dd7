"""Repair of conversations by error-correcting Earley parsing.

A conversation is right if its roles are an optional system turn and then pairs of a user's and an assistant's, or nothing at all. The grammar
is written with one role and one tail in each production, so a completed item only hands on to its tail and items need no origin: a chart set holds, for each symbol that is expected next,
the least (cost, audit) of the edits so far. Scanning keeps a row; the error productions delete a row, change its role, or insert a turn
without reading one. All four add a letter to the audit (K, D, R, I), and of edits that cost the same the audit least in ASCII order stays. That is
safe to decide in each set: two audits of one set that cost the same never begin one another, as only insertions could follow. The completed
chart's audit tells the repair whole: the number of turns left tells the role of each place.

Rows are ordered by turn (nulls first), then role, then a hash of the text. Conversations of at most LONG_ROWS rows and LONG_BYTES of text are sorted and parsed by
the stream of a partition. Longer ones are cut into parts of SEGMENT rows where they lie in a sort by ranges: a part's chart is run from each
symbol, the charts are joined in order, and each part's edits are applied where its rows are. Which rows repeat an earlier one is told there by a minimum over equal rows, not by
a set in one task. Only what is one value by definition (the audit, the hash of a whole conversation) passes through one task, part by part.

Defined results: a null role or text is one space; a null conv_id is a conversation; null turns stand first and leave no gap; repeated rows are duplicates; a role whose
first letter is s, u or a can be kept at such a place, whatever follows; a conversation without rows has no faults and nothing to repair; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, checkpointed, partitions, written

#: Each symbol's productions: a role's initial, and the symbol that is expected after it.
GRAMMAR = {"dialog": (("s", "turns"), ("u", "answer")), "turns": (("u", "answer"),), "answer": (("a", "rest"),), "rest": (("u", "answer"),)}
START, NULLABLE = "dialog", ("dialog", "rest")
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))

LONG_ROWS, LONG_BYTES, SEGMENT = 2048, 1 << 23, 256
#: Long conversations whose ids may be broadcast.
HELD = 10_000

Chart = dict[str, tuple[int, str]]


def inserted(chart: Chart) -> Chart:
    """The chart set with every turn that may be inserted here."""
    todo = list(chart)
    while todo:
        symbol = todo.pop()
        cost, audit = chart[symbol]
        for role, tail in GRAMMAR[symbol]:
            new = (cost + INSERT, audit + "I")
            if role in ROLES and (tail not in chart or new < chart[tail]):
                chart[tail] = new
                todo.append(tail)
    return chart


def scanned(chart: Chart, row: str) -> Chart:
    """The next chart set. row: its role's initial (x for any other), in capitals if it is unfinished, or - if it must go."""
    out: Chart = {}
    extra = UNFINISHED if row.isupper() else 0
    initial = row.lower()
    for symbol, (cost, audit) in chart.items():
        new = [(symbol, (cost + DELETE, audit + "D"))]
        if row != "-":
            for role, tail in GRAMMAR[symbol]:
                if role == initial:
                    new.append((tail, (cost + extra, audit + "K")))
                elif role in ROLES:
                    new.append((tail, (cost + extra + REROLE, audit + "R")))
        for tail, value in new:
            if tail not in out or value < out[tail]:
                out[tail] = value
    return inserted(out)


def chart_of(rows: str, start: str = START) -> Chart:
    chart = inserted({start: (0, "")})
    for row in rows:
        chart = scanned(chart, row)
    return chart


def completed(chart: Chart) -> tuple[int, str]:
    return min(chart[s] for s in NULLABLE if s in chart)


def turns(audit: str, rows: list[tuple[str, str]], before: int, total: int) -> list[dict[str, str]]:
    """The turns that the edits make of rows (role, text): before stand already, total will at the end."""
    out, left = [], iter(rows)
    for letter in audit:
        role, text = (None, "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter != "K":
            role = ROLES["ua"[(before + len(out) - total % 2) % 2]]
        out.append({"role": role, "text": text})
    return out


def symbol(initial: str, unfinished: bool) -> str:
    known = initial if initial in ("s", "u", "a") else "x"
    return known.upper() if unfinished else known


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, there): rows as a fault of transport might leave them, told by crc32 of conv_id and turn; dropped ones stay as rows that are not there."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    luck = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    held = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), luck.alias("luck"))
    text = F.when(F.col("luck") == 1, F.lit("")).when(F.col("luck") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("luck") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.col("luck") != 0))
    return held.select("conv_id", "turn", F.when(F.col("luck") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("there"))


def told(rows: DataFrame) -> DataFrame:
    """rows with what can be said of each alone: initial, blank, unfinished, and h, by which ties are ordered."""
    bare = F.btrim("text", F.lit(ASCII_SPACE))
    return rows.select("conv_id", "turn", "role", "text", "there", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"), ((bare != "") & ~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("unfinished"), F.xxhash64("text").alias("h"))


def order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h"), F.col("text")]


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def schema(kind: str) -> str:
    return f"conv_id {kind}, part long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, turns array<struct<role: string, text: string>>"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def mended(rows: list[dict], known: dict[str, tuple[int, str]]) -> tuple:
    """What schema() asks for of one conversation, without its id and part. known: charts completed before, by their rows."""
    rows = [r for r in rows if r["there"]]
    seen, signs, faults = set(), [], [0, 0, 0]
    for r in rows:
        key = (r["role"], r["text"])
        fault = 0 if r["blank"] else 1 if key in seen else 2 if r["unfinished"] else None
        seen.add(key)
        if fault is not None:
            faults[fault] += 1
        signs.append("-" if fault in (0, 1) else symbol(r["initial"], fault == 2))
    signs = "".join(signs)
    if (found := known.get(signs)) is None:
        found = completed(chart_of(signs))
        if len(signs) <= 32 and len(known) < 100_000:
            known[signs] = found
    cost, audit = found
    numbers = {r["turn"] for r in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return (min(gaps, (1 << 63) - 1), *faults, illegal_pairs([r["initial"] for r in rows]), cost, audit, turns(audit, [(r["role"], r["text"]) for r in rows], 0, len(audit) - audit.count("D")))


def repair_short(rows: DataFrame, kind: str) -> DataFrame:
    """rows: told(). Each conversation's rows meet in one partition, sorted, and are parsed as they come."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now, held, out = {}, None, [], []

        def flush(typed: pa.DataType) -> pa.RecordBatch:
            columns = [pa.array([x[0] for x in out], typed), pa.array([0] * len(out), pa.int64()), *(pa.array([x[1 + k] for x in out], pa.int64()) for k in range(6)), pa.array([x[7] for x in out], pa.string()), pa.array([x[8] for x in out], TURNS)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", *COUNTS, "audit", "turns"])

        typed = None
        for batch in batches:
            typed = batch.schema.field("conv_id").type
            for at in range(0, batch.num_rows, 512):
                for r in batch.slice(at, 512).to_pylist():
                    if held and r["conv_id"] != now:
                        out.append((now, *mended(held, known)))
                        held = []
                    now = r["conv_id"]
                    held.append(r)
                if out:
                    yield flush(typed)
        if held:
            out.append((now, *mended(held, known)))
            yield flush(typed)

    spark = rows.sparkSession
    return rows.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", *order()).drop("h").mapInArrow(run, schema(kind))


def repair_long(rows: DataFrame, kind: str, segment: int) -> DataFrame:
    """The same of conversations of any length, in parts; gaps, illegal and cost stand with the first."""
    spark = rows.sparkSession
    name = F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    keys = [F.col("name"), *order()[:3], F.col("n")]
    ordered = rows.where("there").withColumn("name", name).withColumn("n", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    ordered = written(ordered.withColumn("seg", F.floor(F.col("pos") / segment)).withColumn("h2", F.xxhash64(F.lit("second"), "role", "text")).withColumn("h1", F.xxhash64("role", "text")).drop("n", "h"))
    first = ordered.groupBy("name", "h1", "h2").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    signs = ordered.select("name", "seg", "pos", "initial", "blank", "unfinished", "h1", "h2").join(first, ["name", "h1", "h2"], "left")
    again = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("unfinished"), "truncated")
    signs = signs.withColumn("fault", fault).withColumn("sign", F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known))
    inside = F.array_sort(F.collect_list(F.struct("pos", "sign", "initial")))  # segment rows at most
    segments = signs.groupBy("name", "seg").agg(*(F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")), inside.alias("x"))
    segments = segments.select("name", "seg", "blank", "duplicate", "truncated", F.array_join(F.col("x.sign"), "").alias("signs"), F.col("x.initial").alias("initials"))

    def charts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.to_pydict()
            found = [[{"start": s, "end": e, "cost": c, "audit": a} for s in GRAMMAR for e, (c, a) in chart_of(x, s).items()] for x in held["signs"]]
            bad = [illegal_pairs(x) for x in held["initials"]]
            ends = [(x[0], x[-1]) for x in held["initials"]]
            columns = [*(batch.column(c) for c in ("name", "seg", "blank", "duplicate", "truncated")), pa.array(bad, pa.int64()), pa.array([a for a, _ in ends], pa.string()), pa.array([b for _, b in ends], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])))], names=["name", "seg", "blank", "duplicate", "truncated", "illegal", "first", "last", "chart"])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        """The edits of each part, from the charts of a conversation in order."""
        frame = frame.sort_values("seg")
        chart, came = {START: (0, "")}, []
        for part in frame["chart"]:
            best: dict[str, tuple] = {}
            for x in part:
                if x["start"] in chart:
                    cost, audit = chart[x["start"]]
                    value = (cost + x["cost"], audit + x["audit"])
                    if x["end"] not in best or value < best[x["end"]][0]:
                        best[x["end"]] = (value, x["start"], x["audit"])
            chart = {s: v[0] for s, v in best.items()}
            came.append(best)
        cost, end = min((chart[s], s) for s in NULLABLE if s in chart)
        pieces = []
        for best in reversed(came):
            _, start, audit = best[end]
            pieces.append(audit)
            end = start
        pieces.reverse()
        sizes = [len(p) - p.count("D") for p in pieces]
        illegal = int(frame["illegal"].sum()) + sum(a + b not in LEGAL for a, b in zip(frame["last"], frame["first"][1:], strict=False))
        later = [0] * (len(frame) - 1)
        frame = frame[["name", "seg", "blank", "duplicate", "truncated"]]
        return frame.assign(part=range(len(sizes)), audit=pieces, before=[0, *accumulate(sizes)][:-1], total=sum(sizes), illegal=[illegal, *later], cost=[cost[0], *later])

    edits = segments.mapInArrow(charts, "name string, seg long, blank long, duplicate long, truncated long, illegal long, first string, last string, chart array<struct<start: string, end: string, cost: long, audit: string>>")
    edits = edits.groupBy("name").applyInPandas(joined, "name string, seg long, blank long, duplicate long, truncated long, part long, audit string, before long, total long, illegal long, cost long")
    wide = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("kinds")
    gaps = ordered.groupBy("name").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("kinds")).select("name", F.when(wide.isNull(), 0).otherwise(F.least(wide, F.lit((1 << 63) - 1))).cast("long").alias("gaps"))
    edits = edits.join(gaps, "name").withColumn("gaps", F.when(F.col("part") == 0, F.col("gaps")).otherwise(0))

    def applied(rows: pa.Table, edit: pa.Table) -> pa.Table:
        rows, e = rows.sort_by("pos"), edit.to_pylist()[0]
        made = turns(e["audit"], list(zip(rows["role"].to_pylist(), rows["text"].to_pylist(), strict=True)), e["before"], e["total"])
        columns = [rows["conv_id"].slice(0, 1), pa.array([e["part"]], pa.int64()), *(pa.array([e[c]], pa.int64()) for c in COUNTS), pa.array([e["audit"]], pa.string()), pa.array([made], TURNS)]
        return pa.table(columns, names=["conv_id", "part", *COUNTS, "audit", "turns"])

    return ordered.select("name", "seg", "conv_id", "pos", "role", "text").groupBy("name", "seg").cogroup(edits.groupBy("name", "seg")).applyInArrow(applied, schema(kind))


def parts(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame | None]:
    """schema() for rows (conv_id, turn, role, text, there): of conversations up to the limits, each in one part; and of longer ones in parts, None if there is none."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    facts = told(rows)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("size"))
    long = checkpointed(sizes.where((F.col("n") > long_rows) | (F.col("size") > long_bytes)).select(F.struct("conv_id").alias("long")))
    if not (many := long.count()):
        return repair_short(facts, kind), None
    long = F.broadcast(long) if many <= HELD else long
    same = F.struct("conv_id").eqNullSafe(F.col("long"))
    return repair_short(facts.join(long, same, "left_anti"), kind), repair_long(facts.join(long, same, "left_semi"), kind, segment).unionByName(
        # what is long only by rows that are no longer there
        facts.join(long, same, "left_semi").groupBy("conv_id").agg(F.bool_or("there").alias("some")).where("not some").select("conv_id", F.lit(0).cast("long").alias("part"), *(F.lit(0).cast("long").alias(c) for c in COUNTS), F.lit("").alias("audit"), F.array().cast("array<struct<role: string, text: string>>").alias("turns"))
    )


def repair(rows: DataFrame, **limits: int) -> DataFrame:
    """Repaired conversations of (conv_id, turn, role, text): faults, cost, audit and turns, long ones in parts whose counts add up."""
    short, long = parts(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(True).alias("there")), **limits)
    return short if long is None else short.unionByName(long)


def digest(short: DataFrame, long: DataFrame | None) -> DataFrame:
    """A row for each conversation, its turns by the hash of their lines."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    out = short.select("conv_id", *COUNTS, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    if long is None:
        return out
    kind = short.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A conversation's parts come in order; no more than one is held."""
        now, sums, audit, value, some = None, None, [], None, False
        names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]

        def told_of(typed: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], typed), *(pa.array([s], pa.int64()) for s in sums), pa.array(["".join(audit)], pa.string()), pa.array([value.hexdigest()], pa.string())], names=names)

        typed = None
        for batch in batches:
            typed = batch.schema.field("conv_id").type
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                if sums is None or r["conv_id"] != now:
                    if sums is not None:
                        yield told_of(typed)
                    now, sums, audit, value, some = r["conv_id"], [0] * len(COUNTS), [], hashlib.sha256(), False
                sums = [s + r[c] for s, c in zip(sums, COUNTS, strict=True)]
                audit.append(r["audit"])
                for t in r["turns"]:
                    value.update((("\n" if some else "") + t["role"] + ":" + t["text"]).encode())
                    some = True
        if sums is not None:
            yield told_of(typed)

    whole = long.repartition(partitions(long.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")
    return out.unionByName(whole)
