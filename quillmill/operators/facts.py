"""Decompositions of captions into ranked facts: clean, check, regroup; and a rule-based decomposer."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas
from ..functions.plan import bound
from ..functions.text import count_fact, word_count
from .caption import elements

# Kinds of facts; style fields that are decomposed, in checklist order; limits of a theme.
KINDS = ("subject", "color", "material", "attribute", "action", "position", "count")
STYLE_FIELDS = ("photo", "art_style", "lighting", "aesthetics")
MAX_THEME_FACTS, MAX_THEME_WORDS = 3, 10
LAST_RANK = 99
MAX_FACTS, MAX_FACT_WORDS = 8, 6


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def clean_ranked(items: Column, with_kind: bool = True) -> Column:
    """Facts with text, trimmed, ordered by rank (99 if there is none), equal ranks as they came, and ranked anew from 0."""
    kind = lambda f: F.when(f["kind"].isin(*KINDS), f["kind"]).otherwise("attribute")
    keyed = F.transform(F.coalesce(items, _empty(schemas.FACT if with_kind else schemas.THEME_FACT)), lambda f, i: F.struct(F.coalesce(f["rank"], F.lit(LAST_RANK)).alias("rank"), i.alias("place"), *([kind(f).alias("kind")] if with_kind else []), F.trim(f["text"]).alias("text")))
    # sort_array compares natively, where array_sort goes through an expression for each pair.
    return F.transform(F.sort_array(F.filter(keyed, lambda f: f["text"] != "")), lambda f, i: F.struct(i.cast("int").alias("rank"), *([f["kind"].alias("kind")] if with_kind else []), f["text"].alias("text")))


def normalise_decomposition(d: Column) -> Column:
    """Names trimmed, members sorted, facts cleaned, style fields that are not decomposed left out, every present field's priority 1."""
    groups = F.transform(F.coalesce(d["concept_groups"], _empty(schemas.GROUP)), lambda g: F.struct(F.trim(F.coalesce(g["name"], F.lit(""))).alias("name"), F.array_sort(F.coalesce(g["member_ids"], _empty("int"))).alias("member_ids"), F.coalesce(g["cardinality"], F.lit("vague")).alias("cardinality"), F.coalesce(g["cultural"], F.lit(False)).alias("cultural")))
    style = F.map_filter(F.transform_values(d["style_facts"], lambda k, v: clean_ranked(v, False)), lambda k, v: k.isin(*STYLE_FIELDS))

    def whole(x: Column) -> Column:
        background, style_ = x["background"], x["style"]
        present = F.concat(F.array(F.lit("elements")), F.when(F.size(background) > 0, F.array(F.lit("background"))).otherwise(_empty("string")), F.coalesce(F.map_keys(style_), _empty("string")))
        return F.struct(
            clean_ranked(d["chu_de_chinh"], False).alias("chu_de_chinh"),
            F.coalesce(d["khop_goi_y"], F.lit(False)).alias("khop_goi_y"),
            groups.alias("concept_groups"),
            F.transform_values(d["facts"], lambda k, v: clean_ranked(v)).alias("facts"),
            background.alias("background_facts"),
            style_.alias("style_facts"),
            bound(present, lambda names: F.map_from_arrays(names, F.transform(names, lambda _: F.lit(1)))).alias("field_priority"),
        )

    return bound(F.struct(clean_ranked(d["background_facts"]).alias("background"), style.alias("style")), whole)


def ranked_errors(items: Column, name: Column) -> Column:
    """What is wrong with a ranked list: empty, without a rank 0, or with a fact without text."""

    def found(xs: Column) -> Column:
        return F.when(F.coalesce(F.size(xs), F.lit(-1)) <= 0, F.array(F.concat(name, F.lit(" is empty")))).otherwise(
            F.array_compact(
                F.array(
                    F.when(~F.coalesce(F.exists(xs, lambda f: f["rank"] == 0), F.lit(False)), F.concat(name, F.lit(" has no rank 0"))),
                    F.when(F.exists(xs, lambda f: F.trim(F.coalesce(f["text"], F.lit(""))) == ""), F.concat(name, F.lit(" has a fact without text"))),
                )
            )
        )

    return bound(items, found)


def expected_style_fields(caption: Column) -> Column:
    style = caption["style_description"]
    return F.array_compact(F.array(*(F.when(F.trim(F.coalesce(style[f], F.lit(""))) != "", F.lit(f)) for f in STYLE_FIELDS)))


def validate_decomposition(d: Column, caption: Column) -> Column:
    """The list of what is wrong with a decomposition of a caption with numbered elements.

    Groups or facts that are missing altogether end the check. Each element, a background that is there and each style field that is
    there need ranked facts; groups need a name, a cardinality and members that exist.
    """
    groups, facts, theme = d["concept_groups"], d["facts"], d["chu_de_chinh"]
    none = lambda x: F.coalesce(F.size(x), F.lit(-1)) <= 0
    basic = F.array_compact(F.array(F.when(none(groups), "concept_groups is empty"), F.when(none(facts), "facts is empty")))
    n_words = F.aggregate(F.coalesce(theme, _empty(schemas.THEME_FACT)), F.lit(0), lambda n, f: n + word_count(f["text"]))
    ids = F.transform(elements(caption), lambda e: e["id"])

    def group_errors(g: Column, i: Column) -> Column:
        at = F.concat(F.lit("concept_groups["), i.cast("string"), F.lit("]"))
        card = F.coalesce((g["cardinality"] == "vague") | g["cardinality"].startswith("exact:"), F.lit(False))
        strange = F.array_except(g["member_ids"], ids)
        return F.array_compact(
            F.array(
                F.when(F.coalesce(g["name"], F.lit("")) == "", F.concat(at, F.lit(" has no name"))),
                F.when(~card, F.concat(at, F.lit(" has no valid cardinality"))),
                F.when(g["member_ids"].isNull(), F.concat(at, F.lit(" has no members"))),
                F.when(F.size(strange) > 0, F.concat(at, F.lit(" has unknown members "), F.array_join(strange.cast("array<string>"), ","))),
            )
        )

    expected = expected_style_fields(caption)
    odd = F.array_sort(F.array_except(F.map_keys(d["style_facts"]), expected))
    style = F.when(
        F.size(expected) > 0,
        F.when(d["style_facts"].isNull(), F.array(F.lit("style_facts is missing"))).otherwise(
            F.concat(F.flatten(F.transform(expected, lambda k: ranked_errors(F.try_element_at(d["style_facts"], k), F.concat(F.lit("style_facts."), k)))), F.when(F.size(odd) > 0, F.array(F.concat(F.lit("unexpected style_facts "), F.array_join(odd, ",")))).otherwise(_empty("string")))
        ),
    ).otherwise(_empty("string"))
    ground = F.trim(F.coalesce(caption["compositional_deconstruction"]["background"], F.lit(""))) != ""
    full = F.concat(
        ranked_errors(theme, F.lit("chu_de_chinh")),
        F.array_compact(F.array(F.when(F.size(theme) > MAX_THEME_FACTS, "chu_de_chinh has too many facts"), F.when(n_words > MAX_THEME_WORDS, "chu_de_chinh has too many words"))),
        F.flatten(F.transform(groups, group_errors)),
        F.flatten(F.transform(ids, lambda i: ranked_errors(facts_at(facts, i), F.concat(F.lit("facts."), i.cast("string"))))),
        F.when(ground, ranked_errors(d["background_facts"], F.lit("background_facts"))).otherwise(_empty("string")),
        style,
    )
    return F.when(d.isNull(), F.array(F.lit("no object"))).when(F.size(basic) > 0, basic).otherwise(full)


def texts(items: Column, kind: str = schemas.FACT) -> Column:
    return F.filter(F.transform(F.coalesce(items, _empty(kind)), lambda f: f["text"]), lambda t: F.coalesce(t, F.lit("")) != "")


def facts_at(facts: Column, i: Column) -> Column:
    """The facts of an element's id. They mostly stand at its place; only where they do not are the keys gone through."""
    key = i.cast("string")
    return F.when(F.get(F.map_keys(facts), i) == key, F.get(F.map_values(facts), i)).otherwise(F.try_element_at(facts, key))


def _without(ids: Column, taken: Column) -> Column:
    """ids, repeats included, that are not taken: by hash where none repeats."""

    def left(xs: Column) -> Column:
        return F.when(F.size(F.array_distinct(xs)) == F.size(xs), F.array_except(xs, taken)).otherwise(bound(taken, lambda t: F.filter(xs, lambda x: ~F.array_contains(t, x))))

    return bound(ids, left)


def selection_input(caption: Column, d: Column) -> Column:
    """Facts regrouped for choosing: by concept group, then every element that no group has as a group of its own, named by its first fact.

    Of groups with one name, the second and later get a number after it. Nothing is left out but elements without facts.
    """
    of = lambda i: texts(facts_at(d["facts"], i))
    some = lambda lists: F.filter(lists, lambda x: F.size(x) > 0)
    grouped = F.transform(d["concept_groups"], lambda g: F.struct(F.trim(g["name"]).alias("name"), F.coalesce(g["cultural"], F.lit(False)).alias("cultural"), F.coalesce(g["cardinality"], F.lit("vague")).alias("cardinality"), some(F.transform(g["member_ids"], of)).alias("elements")))
    alone = some(F.transform(_without(F.transform(elements(caption), lambda e: e["id"]), F.flatten(F.transform(d["concept_groups"], lambda g: g["member_ids"]))), of))
    single = F.transform(alone, lambda f: F.struct(f[0].alias("name"), F.lit(False).alias("cultural"), F.lit("exact:1").alias("cardinality"), F.array(f).alias("elements")))
    raw = F.concat(F.coalesce(grouped, _empty("struct<name string, cultural boolean, cardinality string, elements array<array<string>>>")), single)
    whole = lambda g, name: F.struct(name.alias("name"), g["cultural"].alias("cultural"), g["cardinality"].alias("cardinality"), count_fact(g["cardinality"]).alias("so_luong"), g["elements"].alias("elements"))
    groups = bound(raw, lambda gs: F.zip_with(gs, numbered_names(F.transform(gs, lambda g: g["name"])), whole))
    style = F.filter(F.array(*(F.struct(F.lit(k).alias("field"), texts(F.try_element_at(d["style_facts"], F.lit(k)), schemas.THEME_FACT).alias("facts")) for k in STYLE_FIELDS)), lambda s: F.size(s["facts"]) > 0)
    return F.struct(
        F.coalesce(caption["high_level_description"], F.lit("")).alias("high_level_description"),
        texts(d["chu_de_chinh"], schemas.THEME_FACT).alias("chu_de_chinh"),
        F.coalesce(caption["style_description"]["medium"], F.lit("")).alias("medium"),
        groups.alias("groups"),
        texts(d["background_facts"]).alias("background"),
        style.alias("style"),
    ).cast(schemas.SELECTION_INPUT)


def numbered_names(names: Column) -> Column:
    """Names, the n-th of equal ones with ' [n]' after it from the second on. Names that are all different are told so by hash and left as they are."""

    def numbered(xs: Column) -> Column:
        upto = lambda i: F.slice(xs, F.lit(1), i + 1)
        nth = lambda x, i: i + 1 - F.size(F.array_remove(upto(i), x))
        each = F.transform(xs, lambda x, i: bound(nth(x, i), lambda n: F.when(n > 1, F.concat(x, F.lit(" ["), n.cast("string"), F.lit("]"))).otherwise(x)))
        return F.when(F.size(F.array_distinct(xs)) == F.size(xs), xs).otherwise(each)

    return bound(names, numbered)


# --- a rule-based decomposer, for runs without a model

# Words that tell people, vague numbers and backdrops, and places.
PERSON_WORDS = "man|men|woman|women|boy|girl|girls|boys|person|people|child|children|vendor|vendors|tourist|tourists|passenger|passengers|nam|nữ|cô|anh|chị|em|người"
VAGUE_WORDS = "several|numerous|multiple|many|various|a crowd of|a cluster of|a group of|some"
BACKDROP_WORDS = "tree|trees|sky|cloud|clouds|wall|floor|ground|building|road|grass|leaf|leaves"
PLACE_WORDS = "left|right|center|top|bottom|behind"


def whole_words(words_: str) -> str:
    """A pattern for any of the words between characters that are no letter, digit or underscore of any script."""
    return f"(?i)(^|[^\\p{{L}}\\p{{N}}_])({words_})($|[^\\p{{L}}\\p{{N}}_])"


def parted(text: Column) -> Column:
    """The words of a text as whole_words() sees them, lower-cased: cut once, they are held against any list by hash."""
    return F.split(F.lower(text), "[^\\p{L}\\p{N}_]+")


def has_word(parts: Column, words_: str) -> Column:
    """Whether parted() words hold one of a list of single words."""
    return F.arrays_overlap(parts, F.array(*(F.lit(w) for w in words_.split("|") if " " not in w)))


VAGUE_PHRASES = [w for w in VAGUE_WORDS.split("|") if " " in w]
#: The word of each phrase that a text must have to hold it.
VAGUE_HEADS = "|".join(max(p.split(), key=len) for p in VAGUE_PHRASES)
NOTHING = "vật thể"
GROUP_NAMES = {"main": "chủ thể chính", "people": "nhóm người", "others": "vật thể phụ", "backdrop": "cảnh nền"}


def first_words(text: Column, n: int) -> Column:
    """The first words() of a text, which is cut no further than that: one piece before them may be empty, and what is left is the last."""
    return F.slice(F.array_remove(F.split(F.coalesce(text, F.lit("")), "(?U)\\s+", n + 2), ""), 1, n)


#: White space besides blanks, beyond ASCII.
WIDE_SPACE = "[\\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"


def _any(checks: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, checks)


def even(text: Column) -> Column:
    """Whether single blanks are all the white space inside a text, so that its words can be cut without a pattern."""
    other = _any(text.contains(x) for x in ("  ", "\t", "\n", "\x0b", "\x0c", "\r"))
    return ~(other | ((F.octet_length(text) != F.char_length(text)) & text.rlike(WIDE_SPACE)))


def leading(text: Column, n: int) -> Column:
    """The first words of an even() text that does not begin with a blank."""
    return F.rtrim(F.substring_index(text, " ", n))


def head_noun(desc: Column, even_: Column | None = None) -> Column:
    """The first three words without an article, lower-cased, marks at the end off. even_: even() of the text, where it is known."""
    article = lambda x: F.regexp_replace(x, "(?i)^(a|an|the)\\s+", "")
    # Of an even text, an article and three words are all that is looked at.
    head = lambda x, e: F.when(e, leading(article(F.substring_index(F.trim(x), " ", 4)), 3)).otherwise(F.array_join(first_words(article(F.trim(x)), 3), " "))
    short = F.lower(F.regexp_replace(bound(desc, lambda x: head(x, even(x))) if even_ is None else head(desc, even_), "[,.]+$", ""))
    return bound(short, lambda s: F.when(s == "", NOTHING).otherwise(s))


def pieces(text: Column) -> Column:
    """A text cut at commas, semicolons, ' with ' and ' featuring ', lower-cased and trimmed, without blank pieces.

    Where only one of the two words stands, no match can overlap another, and commas take their place.
    """
    marked = F.replace(F.replace(F.replace(text, F.lit(" with "), F.lit(",")), F.lit(" featuring "), F.lit(",")), F.lit(";"), F.lit(","))
    cut = F.when(text.contains(" featuring ") & text.contains(" with "), F.split(F.lower(F.regexp_replace(text, "[,;]| with | featuring ", ",")), ",")).otherwise(F.split(F.lower(marked), ","))
    return F.filter(F.transform(cut, lambda c: F.trim(c)), lambda c: c != "")


def rule_facts(desc: Column) -> Column:
    """A description cut at commas, semicolons and a few joining words: its head noun first, then the parts after the first."""

    def of(text: Column) -> Column:
        place = lambda c: _any(c.contains(w) for w in PLACE_WORDS.split("|")) & has_word(parted(c), PLACE_WORDS)
        fact = lambda words_: lambda c, i: F.struct((i + 1).cast("int").alias("rank"), F.when(place(c), "position").otherwise("attribute").alias("kind"), words_(c).alias("text"))
        undotted = lambda c: F.regexp_replace(c, "\\.+$", "")
        quick = lambda c: leading(F.when(c.endswith("."), undotted(c)).otherwise(c), MAX_FACT_WORDS)
        full = lambda c: F.array_join(first_words(undotted(c), MAX_FACT_WORDS), " ")
        later = F.slice(pieces(text), 2, MAX_FACTS - 1)
        first = lambda e: F.array(F.struct(F.lit(0).alias("rank"), F.lit("subject").alias("kind"), head_noun(text, e).alias("text")))
        return bound(even(text), lambda e: F.concat(first(e), F.when(e, F.transform(later, fact(quick))).otherwise(F.transform(later, fact(full)))))

    return bound(F.coalesce(desc, F.lit("")), of).cast(f"array<{schemas.FACT}>")


def element_signs(caption: Column) -> Column:
    """For each element its kind (people, backdrop or main) and whether its description is vague in number, by its words.

    A description's words are held once against all lists; what they share with them, mostly nothing, is then told apart. A phrase is looked for only where its telling word is.
    """
    telling = F.array_distinct(F.array(*(F.lit(w) for w in f"{PERSON_WORDS}|{BACKDROP_WORDS}|{VAGUE_WORDS}|{VAGUE_HEADS}".split("|") if " " not in w)))

    def of(e: Column) -> Column:
        vague = lambda ws: has_word(ws, VAGUE_WORDS) | (has_word(ws, VAGUE_HEADS) & e["desc"].rlike(whole_words("|".join(VAGUE_PHRASES))))
        told = lambda ws: F.struct(F.when(has_word(ws, PERSON_WORDS), "people").when(has_word(ws, BACKDROP_WORDS), "backdrop").otherwise("main").alias("kind"), F.coalesce(vague(ws), F.lit(False)).alias("vague"))
        return bound(F.array_intersect(parted(e["desc"]), telling), lambda ws: F.when(F.size(ws) > 0, told(ws)).otherwise(F.struct(F.lit("main").alias("kind"), F.lit(False).alias("vague"))))

    return F.transform(elements(caption), of)


def rule_decomposition(caption: Column, signs: Column | None = None) -> Column:
    """A decomposition by fixed rules: elements sorted by keywords into main subjects, people, other things and backdrop.

    signs: element_signs(), for callers that have computed it once (it is used many times here).
    """
    es = elements(caption)
    signs = element_signs(caption) if signs is None else signs
    exact = lambda n: F.concat(F.lit("exact:"), n.cast("string"))
    group = lambda name, members, card: F.struct(F.lit(GROUP_NAMES[name]).alias("name"), members.alias("member_ids"), card.alias("cardinality"), F.lit(False).alias("cultural"))

    def grouped(m: Column) -> Column:
        people, backdrop, other = m["people"], m["backdrop"], m["main"]
        return F.array_compact(
            F.array(
                F.when(F.size(other) > 0, group("main", F.slice(other, 1, 3), exact(F.least(F.size(other), F.lit(3))))),
                F.when(F.size(people) > 0, group("people", people, F.when(m["vague"], "vague").otherwise(exact(F.size(people))))),
                F.when(F.size(other) > 3, group("others", F.slice(other, F.lit(4), F.greatest(F.size(other), F.lit(1))), F.lit("vague"))),
                F.when(F.size(backdrop) > 0, group("backdrop", backdrop, F.lit("vague"))),
            )
        )

    def sorted_(xs: Column) -> Column:
        of = lambda kind: F.transform(F.filter(xs, lambda x: x["kind"] == kind), lambda x: x["id"]).alias(kind)
        return F.struct(of("people"), of("backdrop"), of("main"), F.exists(xs, lambda x: x["vague"]).alias("vague"))

    signed = F.zip_with(es, signs, lambda e, x: F.struct(e["id"].alias("id"), x["kind"].alias("kind"), x["vague"].alias("vague")))
    found = bound(bound(signed, sorted_), grouped)
    groups = bound(found, lambda gs: F.when(F.size(gs) > 0, gs).otherwise(F.array(group("main", F.transform(es, lambda e: e["id"]), F.lit("vague")))))
    ground, style = caption["compositional_deconstruction"]["background"], caption["style_description"]
    parts = lambda v: F.transform(F.filter(F.transform(F.split(F.lower(F.coalesce(v, F.lit(""))), ","), lambda c: F.trim(c)), lambda p: p != ""), lambda p, i: F.struct(i.cast("int").alias("rank"), p.alias("text")))
    return F.struct(
        F.array(F.struct(F.lit(0).alias("rank"), head_noun(F.coalesce(caption["high_level_description"], F.lit(""))).alias("text"))).alias("chu_de_chinh"),
        F.lit(False).alias("khop_goi_y"),
        groups.alias("concept_groups"),
        F.map_from_arrays(F.transform(es, lambda e: e["id"].cast("string")), F.transform(es, lambda e: rule_facts(e["desc"]))).alias("facts"),
        F.when(F.trim(F.coalesce(ground, F.lit(""))) != "", rule_facts(ground)).otherwise(_empty(schemas.FACT)).alias("background_facts"),
        F.map_filter(F.map_from_arrays(F.array(*map(F.lit, STYLE_FIELDS)), F.array(*(parts(style[f]) for f in STYLE_FIELDS))), lambda k, v: F.size(v) > 0).alias("style_facts"),
    ).cast(schemas.DECOMPOSITION)
