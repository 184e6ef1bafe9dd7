"""Choosing facts at three levels of detail: read, check, nest, view, assemble.

A choice (quillmill.schemas.CHOICE) is one level's; a selection has one for each level. Errors are lists of text in the order
of the checks; a level with errors is dropped, and so is one that is not contained in the next more detailed level that is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.plan import bound, once
from ..functions.text import is_plural, original_name, total_words
from .facts import STYLE_FIELDS

# Levels from little to much detail, hints of their length, and the words that are asked for and accepted.
LEVELS = ("short", "medium", "long")
LENGTH_HINTS = {"short": "8-20 từ", "medium": "30-60 từ", "long": "100-200 từ"}
ASKED_WORDS = {"short": 16, "medium": 50, "long": None}
ACCEPTED_WORDS = {"short": 20, "medium": 55, "long": None}
SHORT_MAX_IDEAS = 2


def _empty(kind: str = "string") -> Column:
    return F.array().cast(f"array<{kind}>")


def _or_empty(x: Column, kind: str = "string") -> Column:
    return F.coalesce(x, _empty(kind))


def _only(wanted: Column, allowed: Column) -> Column:
    """Those that are allowed, each once, in the order of the wish. By hash, so that its cost follows the lengths."""
    return F.array_intersect(_or_empty(wanted), _or_empty(allowed))


def _not(wanted: Column, allowed: Column) -> Column:
    """Those that are not allowed, each once."""
    return F.array_except(_or_empty(wanted), _or_empty(allowed))


def allowed_facts(group: Column) -> Column:
    count = F.when(group["so_luong"].isNotNull(), F.array(group["so_luong"])).otherwise(_empty())
    return F.concat(_or_empty(F.flatten(group["elements"])), count)


def sources(sel_input: Column) -> Column:
    """For each group of an input what choices are held against: its description, the facts that may be chosen, and its elements' nouns (their first facts)."""
    nouns = lambda g: F.transform(F.filter(g["elements"], lambda e: F.size(e) > 0), lambda e: e[0])
    return F.transform(
        sel_input["groups"],
        lambda g: F.struct(g["name"].alias("name"), g["cultural"].alias("cultural"), g["cardinality"].alias("cardinality"), g["so_luong"].alias("so_luong"), (F.size(g["elements"]) > 0).alias("some"), allowed_facts(g).alias("allowed"), nouns(g).alias("nouns")),
    )


def named(groups: Column, name: Column) -> Column:
    """The first group of that name; null if there is none."""
    return F.get(F.filter(groups, lambda g: g["name"] == name), F.lit(0))


def _facts_of(styles: Column, field: Column) -> Column:
    return F.get(F.filter(styles, lambda s: s["field"] == field), F.lit(0))["facts"]


def looked_up(choice: Column, of: Column) -> Column:
    """A choice's groups with their sources (null for an unknown name), the facts of them that are allowed and those that are not, and whether their name came before."""
    raw = _or_empty(choice["groups"], schemas.CHOSEN_GROUP)
    names = F.transform(raw, lambda g: g["name"])
    again = lambda g, i: F.coalesce(F.array_position(names, g["name"]) <= i, F.lit(False))
    one = lambda g, i: lambda s: F.struct(g["name"].alias("name"), s.alias("source"), _only(g["facts"], s["allowed"]).alias("facts"), _not(g["facts"], s["allowed"]).alias("bad"), again(g, i).alias("again"))
    return F.transform(raw, lambda g, i: bound(named(of, g["name"]), one(g, i)))


def read_level(level: str, choice: Column, looked: Column, sel_input: Column) -> Column:
    """struct<groups, background, style, medium, usable, errors>: what of a choice is valid, and what is not. looked: looked_up() of the choice."""
    say = lambda *parts: F.concat(F.lit(f"{level}: "), *parts)

    def group_errors(g: Column) -> Column:
        silent = g["source"]["some"] & ~g["source"]["cultural"] & (F.size(g["facts"]) == 0)
        return (
            F.when(g["source"].isNull(), F.array(say(F.lit("unknown group "), F.coalesce(g["name"], F.lit("null")))))
            .when(g["again"], F.array(say(F.lit("group chosen twice "), g["name"])))
            .otherwise(F.array_compact(F.array(F.when(F.size(g["bad"]) > 0, say(F.lit("group "), g["name"], F.lit(" has strange facts "), F.array_join(g["bad"], "; "))), F.when(silent, say(F.lit("group without facts "), g["name"])))))
        )

    fine = F.filter(looked, lambda g: g["source"].isNotNull() & ~g["again"])
    groups = F.transform(fine, lambda g: F.struct(g["name"].alias("name"), g["facts"].alias("facts")))
    bad_ground = _not(choice["background"], sel_input["background"])
    wishes = F.transform(_or_empty(choice["style"], schemas.CHOSEN_STYLE), lambda s: bound(_facts_of(sel_input["style"], s["field"]), lambda there: F.struct(s["field"].alias("field"), there.isNotNull().alias("known"), _only(s["facts"], there).alias("facts"), _not(s["facts"], there).alias("bad"))))
    style_error = lambda s: F.when(~s["known"], say(F.lit("unknown style field "), s["field"])).when(F.size(s["bad"]) > 0, say(F.lit("style "), s["field"], F.lit(" has strange facts "), F.array_join(s["bad"], "; ")))
    no_groups = choice["groups"].isNull() | ((F.size(choice["groups"]) == 0) & (F.size(sel_input["chu_de_chinh"]) == 0))
    errors = F.when(choice.isNull(), F.array(F.lit(f"{level}: missing"))).when(no_groups, F.array(say(F.lit("no groups")))).otherwise(
        F.concat(
            F.flatten(F.transform(looked, group_errors)),
            F.when(F.size(bad_ground) > 0, F.array(say(F.lit("background has strange facts "), F.array_join(bad_ground, "; ")))).otherwise(_empty()),
            F.array_compact(F.transform(wishes, style_error)),
        )
    )
    usable = ~F.coalesce(choice.isNull() | no_groups, F.lit(True))
    style = F.transform(F.filter(wishes, lambda s: F.size(s["facts"]) > 0), lambda s: F.struct(s["field"].alias("field"), s["facts"].alias("facts")))
    return F.struct(
        F.when(usable, groups).otherwise(_empty(schemas.CHOSEN_GROUP)).alias("groups"),
        F.when(usable, _only(choice["background"], sel_input["background"])).otherwise(_empty()).alias("background"),
        F.when(usable, style).otherwise(_empty(schemas.CHOSEN_STYLE)).alias("style"),
        F.coalesce(choice["medium"], F.lit(False)).alias("medium"),
        usable.alias("usable"),
        errors.alias("errors"),
    )


def seen_groups(level: Column, of: Column) -> Column:
    """A level's groups as they are shown: a cultural or silent group's name leads its facts, and groups that are many without a number say so."""

    def group(g: Column) -> Column:
        def shown(x: Column) -> Column:
            source, name = x["source"], x["name"]
            lead = (source["cultural"] | (F.size(g["facts"]) == 0)) & ~F.array_contains(g["facts"], name)
            facts = F.when(lead, F.concat(F.array(name), g["facts"])).otherwise(g["facts"])
            counted = F.coalesce(F.array_contains(g["facts"], source["so_luong"]) | (lead & (name == source["so_luong"])), F.lit(False))
            return F.struct(name.alias("name"), source["cultural"].alias("cultural"), source["cardinality"].alias("cardinality"), (is_plural(source["cardinality"]) & ~counted).alias("so_nhieu"), facts.alias("facts"))

        return bound(F.struct(named(of, g["name"]).alias("source"), original_name(g["name"]).alias("name")), shown)

    return F.transform(level["groups"], group)


def view(level: Column, groups: Column, sel_input: Column) -> Column:
    """A level's content: groups (its seen_groups()), style in fixed order, and the checklist: theme, groups, background, style,
    medium, each text once, where it first stands."""
    style = F.filter(F.array(*(F.struct(F.lit(k).alias("field"), _or_empty(_facts_of(level["style"], F.lit(k))).alias("facts")) for k in STYLE_FIELDS)), lambda s: F.size(s["facts"]) > 0)
    medium = F.when(level["medium"] & (sel_input["medium"] != ""), sel_input["medium"])
    theme = sel_input["chu_de_chinh"]
    everything = F.concat(theme, F.flatten(F.transform(groups, lambda g: g["facts"])), level["background"], F.flatten(F.transform(style, lambda s: s["facts"])), F.when(medium.isNotNull(), F.array(medium)).otherwise(_empty()))
    return F.struct(theme.alias("chu_de_chinh"), groups.alias("groups"), level["background"].alias("background"), style.alias("style"), medium.alias("medium"), F.array_distinct(everything).alias("checklist"))


def short_ideas(level: Column, of: Column) -> Column:
    """Ideas beyond the subjects' own nouns: more groups, background, a medium, and facts that are not an element's first."""
    more = F.aggregate(level["groups"], F.lit(0), lambda n, g: n + F.size(_not(g["facts"], named(of, g["name"])["nouns"])))
    return F.greatest(F.size(level["groups"]) - 1, F.lit(0)) + F.size(level["background"]) + level["medium"].cast("int") + more


def limits(level: str, read: Column, words: Column, ideas: Column) -> Column:
    """Errors of length, and what a short level may not have."""
    cap = ACCEPTED_WORDS[level]
    found = [F.when(words > cap, F.concat(F.lit(f"{level}: "), words.cast("string"), F.lit(f" words, over {ASKED_WORDS[level]}")))] if cap else []
    if level == "short":
        found += [
            F.when(F.size(read["style"]) > 0, "short: has style"),
            F.when(F.size(read["background"]) > 1, "short: more than one background fact"),
            F.when(ideas > SHORT_MAX_IDEAS, F.concat(F.lit("short: "), ideas.cast("string"), F.lit(f" ideas, over {SHORT_MAX_IDEAS}"))),
        ]
    return F.when(read["usable"], F.array_compact(F.array(*found))).otherwise(_empty()) if found else _empty()


def nesting(low: str, high: str, a: Column, b: Column) -> Column:
    """What level a has that the more detailed level b lacks."""
    say = lambda *parts: F.concat(F.lit(f"{low} in {high}: "), *parts)
    lacks = lambda what, name: lambda lost: F.when(F.size(lost) > 0, say(F.lit(f"{what} "), name, F.lit(" lacks "), F.array_join(lost, "; ")))
    group = lambda g: bound(named(b["groups"], g["name"])["facts"], lambda there: F.when(there.isNull(), say(F.lit("no group "), g["name"])).otherwise(bound(_not(g["facts"], there), lacks("group", g["name"]))))
    style = lambda s: bound(_not(s["facts"], _facts_of(b["style"], s["field"])), lacks("style", s["field"]))
    ground = _not(a["background"], b["background"])
    return F.array_compact(
        F.concat(
            F.transform(a["groups"], group),
            F.array(F.when(F.size(ground) > 0, say(F.lit("background lacks "), F.array_join(ground, "; ")))),
            F.transform(a["style"], style),
            F.array(F.when(a["medium"] & ~b["medium"], say(F.lit("no medium")))),
        )
    )


def evaluate(df: DataFrame, selection: str, sel_input: str) -> DataFrame:
    """df with, for each level, read_<level> (what is valid of it), seen_<level> (its view) and words_<level> (of its checklist, without the theme's), with ideas_short,
    errors, levels (those kept, from little to much) and dropped (level and reasons).

    From the most detailed level down, a level without errors is kept if it is contained in the last one kept.
    """
    s, i = F.col(selection), F.col(sel_input)
    out = once(df, _of=sources(i))
    of = F.col("_of")
    out = once(out, **{f"_look_{k}": looked_up(s[k], of) for k in LEVELS})
    out = once(out, **{f"read_{k}": read_level(k, s[k], F.col(f"_look_{k}"), i) for k in LEVELS})
    read = {k: F.col(f"read_{k}") for k in LEVELS}
    out = once(out, ideas_short=short_ideas(read["short"], of), **{f"_groups_{k}": seen_groups(read[k], of) for k in LEVELS})
    out = once(out, **{f"seen_{k}": view(read[k], F.col(f"_groups_{k}"), i) for k in LEVELS})
    out = once(out, _theme=total_words(i["chu_de_chinh"]), **{f"_all_{k}": total_words(F.col(f"seen_{k}")["checklist"]) for k in LEVELS})
    out = out.withColumns({f"words_{k}": F.col(f"_all_{k}") - F.col("_theme") for k in LEVELS})
    own = {f"_own_{k}": F.concat(read[k]["errors"], limits(k, read[k], F.col(f"words_{k}"), F.col("ideas_short"))) for k in LEVELS}
    out = once(out, **own, **{f"_nest_{a}_{b}": nesting(a, b, read[a], read[b]) for a, b in (("short", "medium"), ("medium", "long"), ("short", "long"))})
    fine = {k: F.size(f"_own_{k}") == 0 for k in LEVELS}
    inside = lambda a, b: F.size(f"_nest_{a}_{b}") == 0
    keep_medium = fine["medium"] & (~fine["long"] | inside("medium", "long"))
    keep_short = fine["short"] & F.when(keep_medium, inside("short", "medium")).when(fine["long"], inside("short", "long")).otherwise(True)
    out = out.withColumns({"_keep_long": fine["long"], "_keep_medium": keep_medium, "_keep_short": keep_short})
    why_short = F.when(~fine["short"], F.col("_own_short")).when(F.col("_keep_medium"), F.col("_nest_short_medium")).otherwise(F.col("_nest_short_long"))
    why = {"short": why_short, "medium": F.when(~fine["medium"], F.col("_own_medium")).otherwise(F.col("_nest_medium_long")), "long": F.col("_own_long")}
    both = lambda a, b: F.when(read[a]["usable"] & read[b]["usable"], F.col(f"_nest_{a}_{b}")).otherwise(_empty())
    out = out.withColumns(
        {
            "errors": F.concat(*(F.col(f"_own_{k}") for k in LEVELS), both("short", "medium"), both("medium", "long")),
            "levels": F.array_compact(F.array(*(F.when(F.col(f"_keep_{k}"), F.lit(k)) for k in LEVELS))),
            "dropped": F.array_compact(F.array(*(F.when(~F.col(f"_keep_{k}"), F.struct(F.lit(k).alias("level"), why[k].alias("reasons"))) for k in LEVELS))),
        }
    )
    helpers = ("_of", "_theme", "_look_", "_groups_", "_all_", "_own_", "_nest_", "_keep_")
    return out.drop(*(c for c in out.columns if c.startswith(helpers) and c not in df.columns))


def assemble(evaluated: DataFrame, row_id: str = "id") -> DataFrame:
    """A row for each level kept: id, detail_level, length_hint, the view's parts, and required_facts (the theme)."""
    each = [F.when(F.array_contains("levels", k), F.struct(F.lit(k).alias("detail_level"), F.lit(LENGTH_HINTS[k]).alias("length_hint"), F.col(f"seen_{k}").alias("seen"))) for k in LEVELS]
    rows = evaluated.select(F.col(row_id).alias("id"), F.explode(F.array_compact(F.array(*each))).alias("x"))
    return rows.select("id", "x.detail_level", "x.length_hint", "x.seen.*", F.col("x.seen.chu_de_chinh").alias("required_facts"))


def best_attempt(attempts: DataFrame, row_id: str = "id", levels: str = "levels", attempt: str = "attempt") -> DataFrame:
    """Per id the attempt with most levels, the latest of these. One pass with a maximum per id, no sort."""
    cols = [c for c in attempts.columns if c != row_id]
    best = F.max_by(F.struct(*cols), F.struct(F.size(levels), F.col(attempt))).alias("_best")
    return attempts.groupBy(row_id).agg(best).select(row_id, *(F.col(f"_best.{c}").alias(c) for c in cols))
