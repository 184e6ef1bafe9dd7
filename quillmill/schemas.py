"""Spark types of captions, decompositions, selections and chat rows."""

from __future__ import annotations

ELEMENT = "struct<type string, text string, desc string>"
ELEMENT_WITH_ID = "struct<id int, type string, text string, desc string>"
STYLE = "struct<aesthetics string, lighting string, photo string, medium string, art_style string>"
#: The standalone profile lists art_style before medium.
STYLE_STANDALONE = "struct<aesthetics string, lighting string, photo string, art_style string, medium string>"


def caption(element: str = ELEMENT, style: str = STYLE) -> str:
    """A caption's type: fields in the order in which a label is written."""
    return f"struct<high_level_description string, style_description {style}, compositional_deconstruction struct<background string, elements array<{element}>>>"


FACT = "struct<rank int, kind string, text string>"
THEME_FACT = "struct<rank int, text string>"
GROUP = "struct<name string, member_ids array<int>, cardinality string, cultural boolean>"
#: Maps keep what a document has: facts by element id, style facts by field.
DECOMPOSITION = f"struct<chu_de_chinh array<{THEME_FACT}>, khop_goi_y boolean, concept_groups array<{GROUP}>, facts map<string, array<{FACT}>>, background_facts array<{FACT}>, style_facts map<string, array<{THEME_FACT}>>>"

CHOSEN_GROUP = "struct<name string, facts array<string>>"
CHOSEN_STYLE = "struct<field string, facts array<string>>"
#: What a scorer chooses for one level.
CHOICE = f"struct<groups array<{CHOSEN_GROUP}>, background array<string>, style array<{CHOSEN_STYLE}>, medium boolean>"
INPUT_GROUP = "struct<name string, cultural boolean, cardinality string, so_luong string, elements array<array<string>>>"
#: What a scorer chooses from.
SELECTION_INPUT = f"struct<high_level_description string, chu_de_chinh array<string>, medium string, groups array<{INPUT_GROUP}>, background array<string>, style array<{CHOSEN_STYLE}>>"

MISSING = "array<struct<menh_de string, muc_do string>>"
EXTRA = "array<struct<thong_tin string, muc_do string>>"
MESSAGES = "array<struct<role string, content string>>"
ERROR = "struct<message string, errors array<string>, last_output string>"
