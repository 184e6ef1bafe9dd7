"""Model calls as DataFrame steps.

A scorer is a function of a list of messages to a text. It runs in mapInPandas, a fresh one per partition; a row that fails gets an
error and never stops the others. A partition keeps a window of calls outstanding; how many windows there are at once is how many tasks run.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import squeeze
from ..sources.files import scratch
from .keyed import KeyedTable

Scorer = Callable[[list[dict]], str]
REGISTRY: dict[str, Callable[[], Scorer]] = {}


def register(name: str) -> Callable:
    """Names a maker of scorers."""

    def hold(make: Callable[[], Scorer]) -> Callable[[], Scorer]:
        REGISTRY[name] = make
        return make

    return hold


@register("echo")
def echo() -> Scorer:
    """Answers with the last message: for runs without a model."""
    return lambda messages: messages[-1]["content"]


def preview(df: DataFrame, messages: str = "messages") -> DataFrame:
    """What a run would ask first, without asking it: (role, content) of one row's messages."""
    return df.limit(1).select(F.inline(messages))


def in_window(ask: Callable, items: Iterable, workers: int, wait: Callable[[], None] = lambda: None) -> Iterator:
    """ask's results for items, in their order, so many calls outstanding at once; wait is called before each, one caller at a time."""
    if workers <= 1:
        for item in items:
            wait()
            yield ask(item)
        return
    gate = Lock()

    def call(item):
        with gate:
            wait()
        return ask(item)

    with ThreadPoolExecutor(workers) as pool:
        window: deque = deque()
        for item in items:
            window.append(pool.submit(call, item))
            if len(window) >= workers:
                yield window.popleft().result()
        while window:
            yield window.popleft().result()


def paced(per_second: float | None) -> Callable[[], None]:
    """A wait that lets no more than so many calls a second through."""
    due = [0.0]

    def wait() -> None:
        now = time.monotonic()
        due[0] = max(due[0], now) + 1 / per_second
        time.sleep(max(0.0, due[0] - 1 / per_second - now))

    return wait if per_second else lambda: None


def score(df: DataFrame, make: Callable[[], Scorer] | str, key: str, messages: str = "messages", concurrency: int | None = None, error_length: int = 600, batch: int = 1, workers: int = 1, per_second: float | None = None) -> DataFrame:
    """(key, raw_output, error): a row for each row of df; exactly one of the two is set.

    A partition keeps workers calls outstanding, and no more than per_second start in a second; the rows come out in order. With a batch over 1 a scorer that has many() gets so
    many lists of messages at once and answers with as many texts; if a batch fails, its rows are asked one by one. A scorer that several workers share must allow it.
    """
    maker = REGISTRY[make] if isinstance(make, str) else make
    kind = dict(df.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, wait = maker(), paced(per_second)

        def one(messages: list[dict]) -> tuple[str | None, str | None]:
            try:
                return ask(messages), None
            except Exception as e:  # noqa: BLE001  a row's failure is data
                return None, f"{type(e).__name__}: {e}"[:error_length]

        def several(part: list[list[dict]]) -> list[tuple[str | None, str | None]]:
            if len(part) > 1:
                try:
                    answers = list(ask.many(part))
                    if len(answers) == len(part):
                        return [(a, None) for a in answers]
                except Exception:  # noqa: BLE001, S110  asked again one by one
                    pass
            return [one(m) for m in part]

        size = batch if hasattr(ask, "many") else 1
        for frame in frames:
            asked = [json.loads(text) for text in frame["messages"]]
            parts = (asked[at : at + size] for at in range(0, len(asked), size))
            found = [x for part in in_window(several, parts, workers, wait) for x in part]
            yield pd.DataFrame({key: frame[key], "raw_output": [r for r, _ in found], "error": [e for _, e in found]})

    rows = df.select(key, F.to_json(messages).alias("messages"))
    return (rows.repartition(concurrency) if concurrency else rows).mapInPandas(run, f"{key} {kind}, raw_output string, error string")


def held(df: DataFrame) -> DataFrame:
    """df written to the shared folder, so that a model that answers otherwise the next time is asked once."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repaired(df: DataFrame, make: Callable[[], Scorer] | str, key: str, check: Callable[[Column], Column], fix: Callable[[Column], Column], rounds: int = 3, kept: KeyedTable | None = None, worth: Callable[[Column], Column] | None = None, **how) -> DataFrame:
    """(key, raw_output, attempt, errors, error, why): each row's answer after at most so many rounds, and error_rows() of those that did not settle.

    check gives an answer's errors, fix the message that tells them. A round asks only those whose last answer had errors, with the answer and its errors appended. Each round is kept in
    a table by key with what its rows are asked next, so that a row is asked once a round, whatever is read afterwards, and a run that was broken off goes on with the rounds that are left, if it
    is given the same table; rounds end when none is pending. worth: of a row that never settles the answer of most worth stays, the later of equals, instead of the last.
    """
    spark, value = df.sparkSession, worth or (lambda _: F.lit(0))
    kept = kept or KeyedTable(spark, scratch(spark), (key,), ("attempt",), buckets=16)
    best = "struct<worth: double, attempt: int, raw_output: string, errors: array<string>>"
    fine = (F.size("errors") == 0) | F.col("error").isNotNull()
    for _ in range(rounds):
        if kept.state()["schema"] is None:
            pending = df.select(key, F.col("messages").cast(schemas.MESSAGES).alias("messages"), F.lit(0).alias("attempt"), F.lit(None).cast(best).alias("best"))
        else:
            before = kept.read().select(key, F.struct("messages", "attempt", "best", fine.alias("fine")).alias("b"))
            asked = df.select(key, F.col("messages").cast(schemas.MESSAGES).alias("messages")).join(before, key, "left").where("b is null or (not b.fine and b.attempt < {})".format(rounds))
            pending = asked.select(key, F.coalesce("b.messages", "messages").alias("messages"), F.coalesce("b.attempt", F.lit(0)).alias("attempt"), "b.best")
        pending = held(pending)
        if pending.isEmpty():
            break
        answers = score(pending, make, key, **how).join(pending, key).withColumn("attempt", F.col("attempt") + 1)
        answers = answers.withColumn("errors", F.when(F.col("error").isNull(), check(F.col("raw_output"))).otherwise(F.array("error")))
        now = F.struct(value(F.col("raw_output")).cast("double").alias("worth"), F.col("attempt"), "raw_output", "errors").cast(best)
        better = F.when(F.col("error").isNotNull(), F.col("best")).when(F.col("best").isNull() | (now["worth"] >= F.col("best.worth")), now).otherwise(F.col("best"))
        said = F.struct(F.lit("assistant").alias("role"), F.col("raw_output").alias("content"))
        more = F.concat("messages", F.array(said, fix(F.col("errors")))).cast(schemas.MESSAGES)
        kept.merge(answers.select(key, F.when(fine, F.col("messages")).otherwise(more).alias("messages"), "raw_output", "attempt", "errors", "error", better.alias("best")))
    if kept.state()["schema"] is None:
        return df.select(key, F.lit(None).cast("string").alias("raw_output"), F.lit(0).alias("attempt"), F.array().cast("array<string>").alias("errors"), F.lit(None).cast("string").alias("error")).limit(0).withColumn("why", error_rows())
    done = kept.read().join(df.select(key), key, "left_semi")
    use = (~fine | F.col("error").isNotNull()) & F.col("best").isNotNull() if worth else F.lit(False)
    pick = lambda c: F.when(use, F.col(f"best.{c}")).otherwise(F.col(c)).alias(c)
    return done.select(key, pick("raw_output"), pick("attempt"), pick("errors"), "error").withColumn("why", error_rows())


def corrected_and_judged(
    rejected: DataFrame, writer: Callable[[], Scorer] | str, judge: Callable[[], Scorer] | str, key: str, ask: Column, ask_judge: Callable[[Column], Column], verdict: Callable[[Column], Column], hold: Callable[[DataFrame], DataFrame] = held
) -> DataFrame:
    """(key, corrected_prompt, decision, error): one correction of each rejected row, judged anew. ask: the writer's messages; ask_judge: the judge's, of a corrected prompt; verdict: the
    decision from the judge's answer. A row whose writer or judge failed, or whose correction is blank, has an error and no decision."""
    written_ = hold(score(rejected.withColumn("_ask", ask), writer, key, "_ask")).select(key, squeeze(F.col("raw_output")).alias("corrected_prompt"), F.col("error").alias("_why"))
    tried = rejected.join(written_, key).withColumn("_why", F.coalesce("_why", F.when(F.coalesce(F.trim("corrected_prompt"), F.lit("")) == "", "empty answer")))
    fine = tried.where("_why is null").withColumn("_ask", ask_judge(F.col("corrected_prompt")))
    judged = score(fine, judge, key, "_ask").select(key, F.col("raw_output").alias("_verdict"), F.col("error").alias("_judge"))
    out = tried.join(judged, key, "left").withColumn("error", F.coalesce("_why", "_judge"))
    return out.withColumn("decision", F.when(F.col("error").isNull(), verdict(F.col("_verdict")))).select(key, "corrected_prompt", "decision", "error")


def error_rows() -> Column:
    """For a row that did not settle, an error struct with all errors and the last answer."""
    return F.when((F.size("errors") > 0) | F.col("error").isNotNull(), F.struct(F.coalesce("error", F.lit("errors remain")).alias("message"), F.col("errors"), F.col("raw_output").alias("last_output")))
