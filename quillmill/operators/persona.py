"""Seeded personas for prompt writers, and the specification that a writer gets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import unit_draw
from .facts import STYLE_FIELDS

# Roles and their shares, tones, languages.
ROLES = (("user phổ thông", 0.60), ("designer", 0.10), ("khách ngành cưới - sự kiện", 0.10), ("sinh viên làm đồ án", 0.10), ("nhân viên marketing", 0.10))
TONES = ("mô tả trung tính", "ra lệnh", "kể lể lan man")
VIETNAMESE = "tiếng Việt"
ENGLISH = "tiếng Anh, nhưng GIỮ NGUYÊN các thuật ngữ văn hoá Việt bằng tiếng Việt"


def weighted(draw: Column, choices: tuple[tuple[str, float], ...]) -> Column:
    """The choice in whose stretch of the cumulated weights a draw falls; the last one beyond all."""
    out, upto = None, 0.0
    for name, weight in choices[:-1]:
        upto = round(upto + weight, 10)
        out = F.when(draw < upto, name) if out is None else out.when(draw < upto, name)
    return out.otherwise(choices[-1][0])


def persona(key: Column, seed: int = 3407, english_rate: float = 0.20) -> Column:
    """map<string,string> of role, tone and language, drawn from the seed and the key alone, each on an axis of its own."""
    draw = lambda axis: unit_draw(F.lit(str(seed)), F.lit(axis), key)
    tone = F.get(F.array(*map(F.lit, TONES)), F.floor(draw("tone") * len(TONES)).cast("int"))
    return F.create_map(F.lit("vai"), weighted(draw("role"), ROLES), F.lit("giọng"), tone, F.lit("ngôn ngữ"), F.when(draw("language") < english_rate, ENGLISH).otherwise(VIETNAMESE))


def content(sub: Column) -> Column:
    """What a writer may say: exactly the checklist's facts, grouped; absent parts are null, so that to_json leaves them out."""
    some = lambda x: F.when(F.size(x) > 0, x)
    groups = F.transform(sub["groups"], lambda g: F.struct(g["facts"].alias("facts"), F.when(g["so_nhieu"], True).alias("so_nhieu")))
    of = lambda k: F.coalesce(F.get(F.filter(sub["style"], lambda s: s["field"] == k), F.lit(0))["facts"], F.array().cast("array<string>"))
    style = F.concat(*map(of, STYLE_FIELDS), F.when(sub["medium"].isNotNull(), F.array(sub["medium"])).otherwise(F.array().cast("array<string>")))
    return F.struct(some(sub["chu_de_chinh"]).alias("chu_de_chinh"), groups.alias("groups"), some(sub["background"]).alias("boi_canh"), some(style).alias("phong_cach"))


def specification(sub: Column, persona_: Column) -> Column:
    """content() with level, hint of length and persona before it."""
    return F.struct(sub["detail_level"].alias("detail_level"), sub["length_hint"].alias("length_hint"), persona_.alias("persona"), *(content(sub)[f].alias(f) for f in ("chu_de_chinh", "groups", "boi_canh", "phong_cach")))
