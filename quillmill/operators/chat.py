"""Chat rows: messages, system prompts by level, token masks, batches, running minima."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.plan import bound, small
from ..sources.files import scratch, write_guarded

IGNORED = -100
PAD_TO = 8
#: Characters that go to a tokenizer at once.
PORTION = 200_000


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(system: Column, user: Column, assistant: Column | None = None, reasoning: Column | None = None) -> Column:
    """System and user, and for training the assistant's answer, its reasoning before it if there is one."""
    out = [message("system", system), message("user", user)]
    if assistant is not None:
        said = assistant if reasoning is None else F.when(F.trim(F.coalesce(reasoning, F.lit(""))) != "", F.concat(F.lit("<think>\n"), F.trim(reasoning), F.lit("\n</think>\n\n"), assistant)).otherwise(assistant)
        out.append(message("assistant", said))
    return F.array(*out)


def with_examples(system: Column, examples: list[tuple[str, str]], user: Column) -> Column:
    """System, then example pairs, then user."""
    shots = [m for u, a in examples for m in (message("user", F.lit(u)), message("assistant", F.lit(a)))]
    return F.array(message("system", system), *shots, message("user", user))


def repair_message(errors: Column, ask: str = "Correct these errors and answer with the whole JSON again:") -> Column:
    return message("user", F.concat(F.lit(ask + "\n- "), F.array_join(errors, "\n- ")))


def with_system(rows: DataFrame, prompts: DataFrame, level: str = "mode") -> DataFrame:
    """rows with system, by level, from (level, system); an unknown level fails the job."""
    known = prompts.select(F.col("level").alias(level), "system")
    unknown = F.raise_error(F.concat(F.lit("no system prompt for level "), F.coalesce(F.col(level), F.lit("null"))))
    return rows.join(small(known), level, "left").withColumn("system", F.coalesce("system", unknown.cast("string")))


def drifted(prompts: DataFrame, defaults: DataFrame) -> DataFrame:
    """Levels whose prompt differs from the default, white space at the ends aside."""
    d = defaults.select("level", F.col("system").alias("default"))
    return prompts.join(d, "level").where(F.trim("system") != F.trim("default")).select("level")


def pair_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Each user turn with the assistant's turn right after it, and the conversation's last system turn before it."""
    w = Window.partitionBy(conversation).orderBy(turn)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = turns.withColumns({"next_role": F.lead("role").over(w), "answer": F.lead("text").over(w), "system": F.last(F.when(F.col("role") == "system", F.col("text")), True).over(before)})
    return out.where("role = 'user' and next_role = 'assistant'").select(conversation, turn, "system", F.col("text").alias("user"), "answer")


def tokenised(encode: Callable[[str], list[int]]) -> Callable[[Column], Column]:
    """A tokenizer as an expression maker: any function of a text to ids, run on Arrow batches."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(encode(t)))

    return run


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """One for all tasks that a Python worker runs, with its cache of words."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
    return Tokenizer.from_file(path)


def token_ids(path: str) -> Callable[[Column], Column]:
    """The ids of a tokenizer file, as an expression maker: marks of its own are plain text and none are added. Texts go to the tokenizer by so many characters at once,
    and only their ids are kept, so that memory follows neither how many rows an Arrow batch has nor what the tokenizer notes of each token."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        tokenizer = _tokenizer(path)
        tokenizer.encode_special_tokens = True
        out, there = [None] * len(texts), [i for i, known in enumerate(texts.notna()) if known]
        held = texts.tolist()
        for part in _portions(there, lambda i: len(held[i])):
            for i, x in zip(part, tokenizer.encode_batch([held[i] for i in part], add_special_tokens=False), strict=True):
                out[i] = np.array(x.ids, dtype=np.int32)
        return pd.Series(out, index=texts.index, dtype=object)

    return run


def _portions(items: list[int], size: Callable[[int], int]) -> Iterator[list[int]]:
    """Items in their order, in lists of at most PORTION in size, or of one that is larger."""
    part, total = [], 0
    for i in items:
        if part and total + size(i) > PORTION:
            yield part
            part, total = [], 0
        part.append(i)
        total += size(i)
    if part:
        yield part


def masked(prefix: Column, full: Column) -> Column:
    """struct<input_ids, attention_mask, labels>: only what follows the prefix is learned. The full sequence must begin with the prefix."""
    n = F.size(prefix)
    rest = F.slice(full, n + 1, F.greatest(F.size(full) - n, F.lit(0)))
    labels = F.concat(F.array_repeat(F.lit(IGNORED), n), rest)
    begins = F.slice(full, F.lit(1), n) == prefix
    checked = F.when(begins, labels).otherwise(F.raise_error("the sequence does not begin with its prefix").cast("array<int>"))
    return F.struct(full.alias("input_ids"), F.transform(full, lambda _: F.lit(1)).alias("attention_mask"), checked.alias("labels"))


def supervised_lengths(rows: DataFrame, batch: str, labels: str = "labels") -> DataFrame:
    """(batch, suffix): the last positions whose predictions a padded batch needs: from one before its earliest learned label to the end; all of them if nothing is learned."""
    first = F.array_position(F.transform(labels, lambda x: x != IGNORED), True)
    width = F.max(F.size(labels))
    return rows.groupBy(batch).agg(width.alias("_width"), F.min(F.when(first > 0, first)).alias("_first")).select(batch, F.coalesce(F.least("_width", F.col("_width") - F.col("_first") + 2), "_width").cast("int").alias("suffix"))


def pad_batches(rows: DataFrame, batch: str, ids: str = "input_ids", labels: str = "labels", pad: int = 0) -> DataFrame:
    """Rows right-padded to their batch's longest, rounded up to a multiple of 8. Lengths, not sequences, meet per batch."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    width = (F.ceil(longest / PAD_TO) * PAD_TO).cast("int")
    out = rows.withColumn("width", width).withColumn("_n", F.col("width") - F.size(ids))
    return out.withColumns({"attention_mask": F.concat(F.transform(ids, lambda _: F.lit(1)), F.array_repeat(F.lit(0), F.col("_n"))), ids: F.concat(ids, F.array_repeat(F.lit(pad), F.col("_n"))), labels: F.concat(labels, F.array_repeat(F.lit(IGNORED), F.col("_n")))}).drop("_n")


def as_ids(tokens) -> list[int]:
    """A tokenizer's answer as a list: a list, an array, an object or dict with input_ids, or one row of a batch of one."""
    tokens = tokens["input_ids"] if isinstance(tokens, dict) else getattr(tokens, "input_ids", getattr(tokens, "ids", tokens))
    tokens = tokens.tolist() if hasattr(tokens, "tolist") else list(tokens)
    return [int(t) for t in (tokens[0] if len(tokens) == 1 and isinstance(tokens[0], (list, tuple)) else tokens)]


def template(chat: Column, open_: bool, reasoned: Column) -> Column:
    """Messages as one text, a role mark before each; open_ ends it where the answer begins. The reasoning of a direct answer is an empty block, in both, so that the one begins the other."""
    said = F.array_join(F.transform(chat, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"], F.lit("\n"))), "")
    ahead = F.concat(F.lit("<|assistant|>\n<think>\n"), F.when(reasoned, "").otherwise("\n</think>\n\n"))
    return F.concat(said, ahead) if open_ else said


def row_errors(prompt: Column, reasoning: Column | None = None, reasoned: bool = False) -> Column:
    """Why a row can't be encoded, or null: a blank prompt, or no reasoning where it is to be learned."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    out = F.when(blank(prompt), "empty prompt")
    return out.when(blank(F.lit(None).cast("string") if reasoning is None else reasoning), "no reasoning") if reasoned else out


def encode_rows(rows: DataFrame, ids: Callable[[Column], Column], target_error: Column | None = None, prompt: str = "user_prompt", target: str = "target", system: str = "system", reasoning: str | None = None, most: int = 4096) -> DataFrame:
    """rows with input_ids, attention_mask, labels, n_tokens, error and keep: the prefix (all up to the answer) is not learned, the answer is.

    ids turns a text column into token ids. Rows with a blank prompt, without reasoning where it is asked for, or with an error of their target get no ids; keep says
    that a row has no error and is not too long.
    """
    user, cot = F.trim(F.col(prompt)), F.trim(F.col(reasoning)) if reasoning else None
    error = F.coalesce(row_errors(user, cot, reasoning is not None), target_error if target_error is not None else F.lit(None).cast("string"))
    block = F.concat(F.lit("<think>\n"), cot if reasoning else F.lit(""), F.lit("\n</think>\n\n"))
    answer = F.concat(block, F.col(target))
    prefix = template(messages(F.col(system), user), True, F.lit(reasoning is not None))
    full = template(messages(F.col(system), user, answer), False, F.lit(reasoning is not None))
    out = rows.withColumn("error", error).withColumn("_x", F.when(F.col("error").isNull(), bound(F.struct(ids(prefix).alias("prefix"), ids(full).alias("full")), lambda x: masked(x["prefix"], x["full"]))))
    out = out.withColumns({c: F.col("_x")[c] for c in ("input_ids", "attention_mask", "labels")}).drop("_x")
    return out.withColumn("n_tokens", F.size("input_ids")).withColumn("keep", F.col("error").isNull() & (F.col("n_tokens") <= most))


def kept_rows(encoded: DataFrame, path: str | None = None) -> tuple[DataFrame, dict]:
    """Those to keep, written, and how many were valid, invalid and too long, counted in the same job, so that rows are encoded once; none at all fails the call and leaves nothing."""
    path, bad = path or scratch(encoded.sparkSession), F.col("error").isNotNull()
    counts = {"valid": F.count_if("keep"), "invalid": F.count_if(bad), "too_long": F.count_if(~bad & ~F.col("keep"))}
    seen = write_guarded(encoded, path, counts, lambda n: None if n["valid"] else "no valid row remains after validation and length", F.col("keep"))
    return encoded.sparkSession.read.parquet(path), seen


def longest(encoded: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row: rows and the longest sequence."""
    return encoded.agg(F.count("*").alias("n"), F.max(length).alias("longest"))


def prepared_counts(rows: DataFrame, error: str = "error", length: str = "n_tokens", most: int = 4096) -> DataFrame:
    """One row: valid, invalid, too long."""
    bad = F.col(error).isNotNull()
    return rows.agg(F.count_if(~bad & (F.col(length) <= most)).alias("n_valid"), F.count_if(bad).alias("n_invalid"), F.count_if(~bad & (F.col(length) > most)).alias("n_too_long"))


def running_best(evals: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """Each evaluation with the best loss so far and whether it set it: strictly lower than all before."""
    before = Window.partitionBy(run).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    out = evals.withColumn("_before", F.min(loss).over(before))
    return out.withColumns({"best_so_far": F.least(loss, "_before"), "is_best": F.col("_before").isNull() | (F.col(loss) < F.col("_before"))}).drop("_before")


def accumulation_steps(global_batch: int, per_device: int, world: int) -> int:
    return max(1, -(-global_batch // (per_device * world)))
