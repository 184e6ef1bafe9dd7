import json

import pytest
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.functions import jsonx
from quillmill.operators import caption, facts

GOOD = {
    "high_level_description": "A tea pot",
    "style_description": {"aesthetics": "calm", "lighting": "soft", "photo": "close, warm", "medium": "photograph"},
    "compositional_deconstruction": {"background": "a wall", "elements": [{"type": "obj", "desc": "a brown pot, glazed"}, {"type": "text", "text": "TRÀ", "desc": "letters on top"}]},
}


def errors(spark, doc, profile="pipeline"):
    text = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)
    return spark.createDataFrame([(text,)], "t string").select(caption.validate_text(F.col("t"), profile).alias("e")).first()["e"]


def broken(change):
    doc = json.loads(json.dumps(GOOD))
    change(doc)
    return doc


@pytest.mark.parametrize(
    ("change", "say"),
    [
        (lambda d: d.pop("high_level_description"), "no high_level_description"),
        (lambda d: d["style_description"].update(art_style="flat"), "both"),
        (lambda d: d["style_description"].pop("photo"), "neither"),
        (lambda d: d["compositional_deconstruction"].update(background=""), "no background"),
        (lambda d: d["compositional_deconstruction"].update(elements=[]), "elements is empty"),
        (lambda d: d["compositional_deconstruction"]["elements"][0].update(type="img"), "elements[0]: type"),
        (lambda d: d["compositional_deconstruction"]["elements"][1].pop("text"), "elements[1]: a text element"),
        (lambda d: d["compositional_deconstruction"]["elements"][0].pop("desc"), "elements[0]: no desc"),
    ],
)
def test_each_fault_is_told(spark, change, say):
    found = errors(spark, broken(change))
    assert len(found) == 1 and say in found[0]


def test_sound_and_hopeless_documents(spark):
    assert errors(spark, GOOD) == []
    assert errors(spark, "[1]") == ["no JSON object"]
    assert errors(spark, "{") == ["no JSON object"]
    assert errors(spark, broken(lambda d: d["style_description"].update(art_style=None))) == ["both photo and art_style"]  # presence, not value
    assert errors(spark, broken(lambda d: d["compositional_deconstruction"].update(background="")), "standalone") == []


def test_label_is_ordered_bare_and_literal(spark):
    raw = broken(lambda d: (d.update(bbox=[1]), d["compositional_deconstruction"]["elements"][0].update(bbox=[1, 2])))
    row = spark.createDataFrame([(json.dumps(raw),)], "t string").select(caption.with_ids(caption.parse(F.col("t"))).alias("c"))
    numbered = row.select(F.to_json("c").alias("j")).first()["j"]
    assert [e["id"] for e in json.loads(numbered)["compositional_deconstruction"]["elements"]] == [0, 1]
    label = row.select(caption.label_text(caption.without_ids(F.col("c"))).alias("j")).first()["j"]
    assert label == json.dumps(GOOD, ensure_ascii=False, separators=(",", ":"))
    assert row.select(caption.leftover_ids(F.to_json("c")).alias("n")).first()["n"] == 2


def test_ranked_facts_are_stable(spark):
    items = [(2, "color", " b "), (None, "x", "z"), (2, "odd", "a"), (0, "subject", "s"), (1, "color", "  ")]
    row = spark.createDataFrame([(items,)], f"i array<{schemas.FACT}>").select(facts.clean_ranked(F.col("i")).alias("x")).first()["x"]
    assert [(f["rank"], f["kind"], f["text"]) for f in row] == [(0, "subject", "s"), (1, "color", "b"), (2, "attribute", "a"), (3, "attribute", "z")]


def test_names_are_numbered(spark):
    row = spark.createDataFrame([(["a", "b", "a", "a"],)], "n array<string>").select(facts.numbered_names(F.col("n")).alias("x")).first()["x"]
    assert row == ["a", "b", "a [2]", "a [3]"]


def test_answers(spark):
    cases = {
        '<think>{"a":1}</think> ```json\n{"b":2}\n```': ('{"b":2}', None),
        'Sure: {"b":2} done': ('{"b":2}', None),
        "[1]": (None, "not an object"),
        "none": (None, "no braces"),
        '{"b":': (None, "no braces"),
        '{"b":[}': (None, "does not parse"),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", jsonx.extracted_object(F.col("t")).alias("x")).collect()
    assert {r["t"]: (r["x"]["json"], r["x"]["error"]) for r in rows} == cases


def test_texts_keep_their_order(spark):
    doc = {"b": {"bbox": 1, "c": [{"x": None, "color_palette": 2}]}, "a": None}
    row = spark.createDataFrame([(json.dumps(doc),)], "t string").select(jsonx.drop_keys("t").alias("d"), jsonx.reordered(["a"])("t").alias("o")).first()
    assert row["d"] == '{"b":{"c":[{"x":null}]},"a":null}'
    assert row["o"].startswith('{"a":null,"b"')
