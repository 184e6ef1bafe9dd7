"""Captions: normalise, validate, strip, measure, write as labels.

A caption column is a struct of quillmill.schemas.caption(). A field that is absent and one that is null are one thing in a struct;
where the difference counts, as in the choice between photo and art_style, validate() reads the document's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.jsonx import is_object
from ..functions.text import word_count

TOP_FIELDS = ("high_level_description", "style_description", "compositional_deconstruction")
ELEMENT_TYPES = ("obj", "text")


def parse(text: Column, profile: str = "pipeline") -> Column:
    """The caption in a JSON document: known fields in label order, others (boxes, palettes) left behind."""
    return F.from_json(text, schemas.caption(style=schemas.STYLE_STANDALONE if profile == "standalone" else schemas.STYLE))


def elements(caption: Column) -> Column:
    """The list of elements, numbered or not; empty if there is none."""
    return F.flatten(F.array_compact(F.array(caption["compositional_deconstruction"]["elements"])))


def with_ids(caption: Column) -> Column:
    """Each element numbered by its place, from 0, the number first."""
    numbered = F.transform(caption["compositional_deconstruction"]["elements"], lambda e, i: F.struct(i.cast("int").alias("id"), e["type"].alias("type"), e["text"].alias("text"), e["desc"].alias("desc")))
    return caption.withField("compositional_deconstruction.elements", numbered)


def without_ids(caption: Column) -> Column:
    """The label form: elements without their numbers."""
    bare = F.transform(caption["compositional_deconstruction"]["elements"], lambda e: F.struct(e["type"].alias("type"), e["text"].alias("text"), e["desc"].alias("desc")))
    return caption.withField("compositional_deconstruction.elements", bare)


def element_by_id(caption: Column, element_id: Column) -> Column:
    """The element of that number; null if there is none."""
    return F.get(F.filter(elements(caption), lambda e: e["id"] == element_id), F.lit(0))


def label_text(caption: Column) -> Column:
    """Minified JSON in field order, absent fields left out, characters literal: what a model is trained to write."""
    return F.to_json(caption)


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) == ""


def _element_errors(e: Column, i: Column) -> Column:
    at = F.concat(F.lit("elements["), i.cast("string"), F.lit("]"))
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(e["type"].isin(*ELEMENT_TYPES), F.lit(False)), F.concat(at, F.lit(": type is neither obj nor text"))),
            F.when((e["type"] == "text") & _blank(e["text"]), F.concat(at, F.lit(": a text element has no text"))),
            F.when(_blank(e["desc"]), F.concat(at, F.lit(": no desc"))),
        )
    )


def validate(caption: Column, has: dict[str, Column] | None = None, profile: str = "pipeline") -> Column:
    """The list of what is wrong with a caption, empty if nothing is.

    has tells presence by name ("photo", "art_style", "background" and the top fields) where the source can tell absent from
    null; by default a field is there if it is not null. The standalone profile only asks that a background be there, empty or not.
    """
    style, composition = caption["style_description"], caption["compositional_deconstruction"]
    there = {"photo": style["photo"].isNotNull(), "art_style": style["art_style"].isNotNull(), "background": composition["background"].isNotNull()}
    there |= {f: caption[f].isNotNull() for f in TOP_FIELDS}
    there |= has or {}
    no_background = ~there["background"] if profile == "standalone" else _blank(composition["background"])
    list_ = composition["elements"]
    none = F.coalesce(F.size(list_), F.lit(0)) <= 0
    top = [F.when(~there[f], f"no {f}") for f in TOP_FIELDS]
    styled = F.when(style.isNull(), "style_description is no object").when(there["photo"] & there["art_style"], "both photo and art_style").when(~there["photo"] & ~there["art_style"], "neither photo nor art_style")
    composed = F.when(composition.isNull(), "compositional_deconstruction is no object")
    ground = F.when(composition.isNotNull() & no_background, "no background")
    empty = F.when(composition.isNotNull() & none, "elements is empty or no list")
    first = F.array_compact(F.array(*top, styled, composed, ground, empty))
    rest = F.flatten(F.transform(elements(caption), _element_errors))
    return F.concat(first, rest)


def validate_text(text: Column, profile: str = "pipeline") -> Column:
    """validate() on a JSON document, presence told by its keys; one error if it is no object."""
    keys = lambda path: F.json_object_keys(F.get_json_object(text, path))
    holds = lambda path, key: F.coalesce(F.array_contains(keys(path), key), F.lit(False))
    has = {f: F.coalesce(F.array_contains(F.json_object_keys(text), f), F.lit(False)) for f in TOP_FIELDS}
    has |= {f: holds("$.style_description", f) for f in ("photo", "art_style")} | {"background": holds("$.compositional_deconstruction", "background")}
    return F.when(is_object(text), validate(parse(text, profile), has, profile)).otherwise(F.array(F.lit("no JSON object")))


def keep_valid(df: DataFrame, errors: str = "errors", strict: bool = True) -> DataFrame:
    """Strictly, rows without errors; else all rows, their errors beside them."""
    return df.where(F.size(errors) == 0) if strict else df


def measures(caption: Column) -> list[Column]:
    """Per caption: elements, text elements, and words of each part."""
    es = elements(caption)
    return [
        F.size(es).alias("n_elements"),
        F.size(F.filter(es, lambda e: e["type"] == "text")).alias("n_text_elements"),
        word_count(caption["high_level_description"]).alias("words_high_level"),
        word_count(caption["compositional_deconstruction"]["background"]).alias("words_background"),
        F.aggregate(es, F.lit(0), lambda n, e: n + word_count(e["desc"])).alias("words_desc_total"),
    ]


def leftover_ids(label: Column) -> Column:
    """How many elements of a label's JSON text still carry an id."""
    es = F.from_json(F.get_json_object(label, "$.compositional_deconstruction.elements"), "array<map<string,string>>")
    return F.coalesce(F.size(F.filter(es, lambda e: F.map_contains_key(e, "id"))), F.lit(0)) * (es.isNotNull()).cast("int")
