"""Documents and JSON lines in, JSON lines and reports out."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import is_object
from ..functions.plan import small
from . import store
from .store import exists

MAX_ERRORS = 500


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(id, text): a row for each .txt or .json file right in a folder, the whole file one record, its stem the id. No files fail the call, which lists names and reads no text."""
    read = spark.read.text(folder, wholetext=True, pathGlobFilter="*.{txt,json}")
    if not read.inputFiles():
        raise ValueError(f"no .txt or .json files in {folder}")
    return read.select(F.regexp_replace(F.col("_metadata.file_name"), "\\.(txt|json)$", "").alias("id"), F.col("value").alias("text"))


def parsed(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents that are JSON objects; and (id, kind, message) of the others, whose text is cut to 400 characters."""
    fine = F.coalesce(is_object(F.col(text)), F.lit(False))
    why = F.when(F.try_parse_json(text).isNull(), "does not parse: ").otherwise("no object: ")
    return docs.where(fine), docs.where(~fine).select("id", F.lit("parse").alias("kind"), F.concat(why, F.substring(text, 1, 400)).alias("message"))


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, text): of each JSON-lines file the first line that does not parse, its number from 1, its text cut to 200 characters.

    A file's lines are numbered by where their block begins and their order in it, and only those of files that have a bad line.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), place.alias("place"), "value")
    wrong = lines.where((F.trim("value") != "") & F.try_parse_json("value").isNull())
    first = wrong.groupBy("path").agg(F.min(F.struct("place", "value")).alias("bad"))
    upto = lines.select("path", "place").join(small(first), "path").where(F.col("place") <= F.col("bad.place"))
    return upto.groupBy("path", F.substring("bad.value", 1, 200).alias("text")).agg(F.count("*").alias("line_no")).select("path", "line_no", "text")


def read_jsonl(spark: SparkSession, path: str, schema: str, check: bool = True) -> DataFrame:
    """Strict: blank lines are skipped. A malformed line fails the call with its path and line number; unchecked, it fails the job that meets it.

    Checked, the rows are parsed and written in one pass over the file, which also counts what does not parse; only if there is such a line are lines numbered.
    """
    if not check:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    held = scratch(spark)
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("x")).select("x.*")

    def why(seen: dict) -> str | None:
        if not seen["bad"]:
            return None
        bad = bad_lines(spark, path).orderBy("path").first()
        return f"{bad['path']}:{bad['line_no']}: not JSON: {bad['text']}" if bad else "a line does not fit the schema"

    write_guarded(rows, held, {"bad": F.count_if(F.col("_corrupt_record").isNotNull())}, why, drop=["_corrupt_record"])
    return spark.read.parquet(held)


def read_jsonl_lenient(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Malformed lines leave a row whose _corrupt_record is set."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def read_jsonl_rows(spark: SparkSession, path: str, raw: list[str], schema: str) -> DataFrame:
    """Strict, objects only; the raw fields stay JSON text, so that key order and absent keys survive."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    bad = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 200)))
    whole = F.when(is_object(F.col("value")), F.col("value")).otherwise(bad.cast("string"))
    return lines.select(whole.alias("value")).select(F.from_json("value", schema).alias("x"), *(F.get_json_object("value", f"$.{f}").alias(f) for f in raw)).select("x.*", *raw)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_jsonl(df: DataFrame, path: str) -> int:
    """Overwrites; the number of rows written, counted while they are."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def write_guarded(df: DataFrame, path: str, counts: dict[str, Column], refuse: Callable[[dict], str | None], keep: Column | None = None, drop: list[str] | None = None, kind: str = "parquet") -> dict:
    """Writes df (where keep holds, without the columns to drop) and gives counts of all its rows, taken in the same job. If refuse finds a reason in them the call fails
    with it, and what path held before stays."""
    spark, seen, draft = df.sparkSession, Observation(), f"{path.rstrip('/')}-draft-{uuid.uuid4().hex}"
    rows = df.observe(seen, *(c.alias(n) for n, c in counts.items()))
    (rows if keep is None else rows.where(keep)).drop(*(drop or [])).write.format(kind).save(draft)
    found = seen.get
    if why := refuse(found):
        store.remove(spark, draft)
        raise ValueError(why)
    store.replace(spark, draft, path)
    return found


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder for each split."""
    df.write.mode("overwrite").partitionBy(split).json(path)


def write_errors(errors: DataFrame, path: str) -> None:
    """The first errors, by id; also when there are none, so that an old list does not stay."""
    errors.orderBy("id").limit(MAX_ERRORS).coalesce(1).write.mode("overwrite").json(path)


def write_config(spark: SparkSession, config: dict, path: str) -> str:
    """What a run was made with (its options, prompts by level and their origin, whatever an adapter must carry along), as pretty JSON beside its results."""
    text = json.dumps(config, ensure_ascii=False, indent=2, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


#: Paths that scratch() gave out in this process.
_GIVEN: list[str] = []


def sweep(spark: SparkSession) -> int:
    """Removes what was written to scratch paths in this process, for the end of a job: results that are read from them must have been written elsewhere. The number of paths."""
    n = len(_GIVEN)
    while _GIVEN:
        store.remove(spark, _GIVEN.pop())
    return n


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names; in a temporary one only where it is unset and all of Spark is one local process, as in tests."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-scratch-")
    _GIVEN.append(f"{folder.rstrip('/')}/scratch-{uuid.uuid4().hex}")
    return _GIVEN[-1]


def write_report(report: DataFrame, path: str) -> str:
    """A report of one row as JSON text, pretty, and written beside the data."""
    row = report.limit(1).toJSON().first() or "{}"
    text = json.dumps(json.loads(row), ensure_ascii=False, indent=2)
    report.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def first_split_folder(spark: SparkSession, explicit: str | None, candidates: list[str], splits: tuple[str, ...] = ("train", "val", "test")) -> str:
    """The explicit folder, or the first candidate that holds any split's file or folder."""
    if explicit:
        return explicit
    for folder in candidates:
        for name in (f"{s}{end}" for s in splits for end in ("", ".jsonl")):
            for child in (name, f"split={name}"):
                if exists(spark, f"{folder}/{child}"):
                    return folder
    raise FileNotFoundError(f"no split in {candidates}")
