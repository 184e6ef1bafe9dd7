"""JSON expressions. Walks of any depth are relations (functions.walk), but where the source's own order of keys must survive."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys that captions carry and labels must not.
DROPPED_KEYS = ("bbox", "color_palette")
# What a label must have at its top.
REQUIRED = ("high_level_description", "style_description", "compositional_deconstruction")


def is_object(text: Column) -> Column:
    return F.json_object_keys(text).isNotNull()


def unfenced(text: Column) -> Column:
    """Without a code fence's first and last line, if the text is fenced."""
    s = F.trim(F.btrim(text, F.lit(" \t\n\r")))
    return F.when(s.startswith("```"), F.btrim(F.regexp_replace(F.regexp_replace(s, "\\A```[^\\n]*\\n?", ""), "\\n?```[^\\n]*\\z", ""), F.lit(" \t\n\r"))).otherwise(s)


def braced(text: Column) -> Column:
    """From the first { to the last }; null if there is no such stretch."""
    first, back = F.locate("{", text), F.locate("}", F.reverse(text))
    length = F.char_length(text) - back + 1 - first + 1
    return F.when((first > 0) & (back > 0) & (length > 0), F.substring(text, first, length))


def lenient_json(text: Column) -> Column:
    """The JSON text in a model's answer: the unfenced answer if it parses, else its braced part if that does, else null."""
    plain = unfenced(text)
    part = braced(plain)
    ok = lambda s: F.try_parse_json(s).isNotNull()
    return F.when(ok(plain), plain).when(ok(part), part)


def extracted_object(text: Column) -> Column:
    """struct<json, error>: the object in an answer; what precedes the last </think> and a fence around the whole are left out. Or why there is none."""
    answer = F.btrim(F.substring_index(text, "</think>", -1), F.lit(" \t\n\r"))
    answer = F.regexp_replace(F.regexp_replace(answer, "(?i)\\A```(?:json)?\\s*", ""), "\\s*```\\s*\\z", "")
    part, ok = braced(answer), lambda s: F.try_parse_json(s).isNotNull()
    found = F.when(ok(answer), answer).when(ok(part), part)
    error = F.when(found.isNotNull() & is_object(found), F.lit(None).cast("string")).when(found.isNotNull(), "not an object").when(part.isNull(), "no braces").otherwise("does not parse")
    return F.struct(F.when(error.isNull(), found).alias("json"), error.alias("error"))


def chat_content(response: Column) -> Column:
    """The first choice's message of a chat-completion response; null if it has none."""
    return F.get_json_object(response, "$.choices[0].message.content")


# --- texts whose order of keys stays


def _udf(of: Callable, kind: T.DataType = T.StringType()):
    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else of(t))

    return run


def _loaded(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return None


def without_keys(value, keys=DROPPED_KEYS):
    if isinstance(value, dict):
        return {k: without_keys(v, keys) for k, v in value.items() if k not in keys}
    return [without_keys(v, keys) for v in value] if isinstance(value, list) else value


#: JSON text without boxes and palettes at any depth, source order kept, minified, characters literal.
drop_keys = _udf(lambda t: json.dumps(without_keys(_loaded(t)), ensure_ascii=False, separators=(",", ":")))
def reordered(order: list[str]):
    """An expression maker: an object's known keys in that order, then the others as they come."""
    return _udf(lambda t: json.dumps(_ordered(_loaded(t), order), ensure_ascii=False, separators=(",", ":")))


def _ordered(value, order: list[str]):
    if not isinstance(value, dict):
        return value
    return {**{k: value[k] for k in order if k in value}, **{k: v for k, v in value.items() if k not in order}}


def _marked(text: Column) -> Column:
    """JSON, minified, with each key between two control characters, which no JSON text holds, and each text value blank."""
    bare = F.regexp_replace(F.to_json(F.try_parse_json(text)), r"\\.", "")  # no escapes, so that a quote is where a text begins or ends
    return F.regexp_replace(F.regexp_replace(bare, '"([^"]*+)":', "\u0001$1\u0002"), '"[^"]*+"', '""')


def label_error(target: Column, allow_boxes: bool = False) -> Column:
    """Why a training target (JSON text) is no label, or null: no JSON, no object, a part is missing, nulls, ids, or boxes and palettes unless allowed. JVM-side, at any depth; what follows a complete document is not looked at:
    nulls and keys are found in the text."""
    text = F.trim(target)
    deep = F.get_json_object(text, "$.compositional_deconstruction")
    top = F.json_object_keys(text)
    lacks = lambda names, keys: F.array_except(F.array(*map(F.lit, names)), F.coalesce(keys, F.array().cast("array<string>")))
    key = lambda names: _marked(text).rlike("\u0001(" + "|".join(names) + ")\u0002")
    out = F.when(F.try_parse_json(text).isNull(), "not JSON").when(top.isNull(), "not an object").when(F.size(lacks(REQUIRED, top)) > 0, F.concat(F.lit("lacks "), F.array_join(lacks(REQUIRED, top), ", ")))
    out = out.when(F.size(lacks(("background", "elements"), F.json_object_keys(deep))) > 0, "lacks background or elements").when(_marked(text).rlike("[\u0002\\[,]null[,}\\]]"), "has nulls").when(key(("id",)), "has ids")
    return out if allow_boxes else out.when(key(DROPPED_KEYS), "has boxes or palettes")
