"""Steps joined into plans: captions to selections to training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import once
from ..operators import caption, facts, persona, selection
from ..operators.chat import message, with_examples


def decomposed(captions: DataFrame, c: str = "caption") -> DataFrame:
    """captions with decomposition by rules, cleaned; the model's place in runs without one."""
    seen = once(captions, _signs=facts.element_signs(F.col(c)))
    raw = once(seen, _raw=facts.rule_decomposition(F.col(c), F.col("_signs")))
    return once(raw, decomposition=facts.normalise_decomposition(F.col("_raw"))).drop("_raw", "_signs")


def selectable(decomposed_: DataFrame, c: str = "caption") -> DataFrame:
    return once(decomposed_, sel_input=facts.selection_input(F.col(c), F.col("decomposition")))


def rule_selection(sel_input: Column) -> Column:
    """A selection by rules, nested as it should be: first group's first fact; two groups' first facts and the background's first; everything."""
    first = lambda g, n: F.slice(F.flatten(g["elements"]), 1, n)
    group = lambda n: lambda g: F.struct(g["name"].alias("name"), first(g, n).alias("facts"))
    whole = lambda g: F.struct(g["name"].alias("name"), F.flatten(g["elements"]).alias("facts"))
    none = F.array().cast("array<struct<field string, facts array<string>>>")
    level = lambda groups, ground, style, medium: F.struct(groups.alias("groups"), ground.alias("background"), style.alias("style"), F.lit(medium).alias("medium"))
    nothing = F.array().cast("array<string>")
    return F.struct(
        level(F.transform(F.slice(sel_input["groups"], 1, 1), group(1)), nothing, none, False).alias("short"),
        level(F.transform(F.slice(sel_input["groups"], 1, 2), group(2)), F.slice(sel_input["background"], 1, 1), none, False).alias("medium"),
        level(F.transform(sel_input["groups"], whole), sel_input["background"], sel_input["style"], True).alias("long"),
    )


def decompose_messages(system: Column, c: Column, hint: Column) -> Column:
    """What a model is asked to decompose: a hint of the topic and the numbered caption, as JSON."""
    return F.array(message("system", system), message("user", F.to_json(F.struct(hint.alias("goi_y_chu_de"), c.alias("caption")))))


def select_messages(system: Column, sel_input: Column) -> Column:
    return F.array(message("system", system), message("user", F.to_json(sel_input)))


def write_messages(system: Column, spec: Column, examples: list[tuple[str, str]] = ()) -> Column:
    """What a writer is asked: examples of specifications and prompts, then the specification, absent parts left out."""
    return with_examples(system, list(examples), F.to_json(spec))


#: Instructions of each model step, to be replaced by a user's own: (stage, level or null for all, text).
INSTRUCTIONS = (
    ("decompose", None, "List the theme, the groups of elements and each element's facts of this caption as JSON."),
    ("select", None, "Choose facts for a short, a medium and a long request, each contained in the next, as JSON."),
    ("write", "short", "Write a request of a few words that states every fact given and nothing else."),
    ("write", "medium", "Write a request of a few sentences that states every fact given and nothing else."),
    ("write", "long", "Write a detailed request that states every fact given and nothing else."),
    ("judge", None, "Say as JSON which facts the request lacks and what it adds."),
    ("correct", None, "Rewrite the request so that it states what was missing and leaves out what was added."),
)


def instructions(spark: SparkSession, own: DataFrame | None = None) -> DataFrame:
    """(stage, level, system, origin): the instructions, those of own (stage, level, system) in place of the built-in ones."""
    base = spark.createDataFrame(list(INSTRUCTIONS), "stage string, level string, system string")
    if own is None:
        return base.withColumn("origin", F.lit("default"))
    o = own.select(F.col("stage").alias("s"), F.col("level").alias("l"), F.col("system").alias("own"))
    joined = base.join(o, (F.col("s") == F.col("stage")) & F.col("l").eqNullSafe(F.col("level")), "left")
    return joined.select("stage", "level", F.coalesce("own", "system").alias("system"), F.when(F.col("own").isNull(), "default").otherwise("own").alias("origin"))


def prompt_rows(subs: DataFrame, written: DataFrame) -> DataFrame:
    """Written prompts with what they were written from: subs (id, detail_level, checklist, ...) that have a row in written (id, detail_level, persona, user_prompt, n_words)."""
    sub = F.struct(*(F.col(c) for c in subs.columns))
    held = subs.select("id", "detail_level", "checklist", persona.content(sub).alias("menh_de_theo_nhom"), F.coalesce("required_facts", F.array().cast("array<string>")).alias("required_facts"))
    return held.join(written.select("id", "detail_level", "persona", "user_prompt", "n_words"), ["id", "detail_level"]).select("id", "detail_level", "persona", "user_prompt", "n_words", "checklist", "menh_de_theo_nhom", "required_facts")


def judge_messages(system: Column, prompt: Column, grouped: Column, flat: Column) -> Column:
    """The judge sees the facts grouped as the writer did, or flat where a row has no groups."""
    user = F.when(grouped.isNotNull(), F.to_json(F.struct(prompt.alias("user_prompt"), grouped.alias("menh_de_theo_nhom")))).otherwise(F.to_json(F.struct(prompt.alias("user_prompt"), flat.alias("checklist"))))
    return F.array(message("system", system), message("user", user))


def correct_messages(system: Column, prompt: Column, checklist: Column, missing: Column, extra: Column) -> Column:
    return F.array(message("system", system), message("user", F.to_json(F.struct(prompt.alias("user_prompt"), checklist.alias("checklist"), missing.alias("missing"), extra.alias("extra")))))


def sub_rows(captions: DataFrame, choose=rule_selection, row_id: str = "id") -> DataFrame:
    """From captions with numbered elements to a row for each level kept."""
    chosen = once(selectable(decomposed(captions)), selection=choose(F.col("sel_input")))
    return selection.assemble(selection.evaluate(chosen, "selection", "sel_input"), row_id)


def numbered(captions: DataFrame, c: str = "caption") -> DataFrame:
    return once(captions, **{c: caption.with_ids(F.col(c))})
