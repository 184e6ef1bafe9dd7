"""The test tables in the roles of captions, selections, verdicts and chat rows; and the same in SQL.

Faults are put in by rules on doc_id, so that every check has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import once, spread
from ..operators import facts
from ..plans import curation
from .registry import table

# --- SQL pieces


def ws(x: str) -> str:
    return f"list_filter(string_split_regex(coalesce({x}, ''), '\\s+'), lambda w: w <> '')"


def wc(x: str) -> str:
    return f"len({ws(x)})"


def joined(x: str, mark: str = " ") -> str:
    return f"array_to_string({x}, '{mark}')"


def at_rank(values: str, rank: str) -> str:
    """The value of a rank, from 0, in a group."""
    return f"list_sort(list({values}) FILTER (WHERE {values} IS NOT NULL))[1 + ({rank})::BIGINT]"


def nearest(values: str, q: float) -> str:
    return at_rank(values, f"floor({q} * (count({values}) - 1))")


CAPS = r"""caps AS (
  SELECT doc_id, lang, source, text, lang || '_' || source || '_' || lpad(doc_id::VARCHAR, 6, '0') AS id,
         string_split(text, chr(10)) AS ls, ls[1] AS high, ls[2] AS ground,
         list_transform(ls[3:], lambda l: {'type': CASE WHEN contains(l, '$$$') THEN 'mark' WHEN regexp_matches(l, '[0-9:]') THEN 'text' ELSE 'obj' END, 'text': CASE WHEN regexp_matches(l, '[0-9:]') THEN l END, 'desc': l}) AS es,
         source || ', ' || lang AS aesthetics, CASE WHEN doc_id % 3 = 0 THEN 'soft light, Dusk' END AS lighting,
         CASE WHEN doc_id % 17 <> 4 AND (doc_id % 2 = 0 OR doc_id % 13 = 1) THEN 'candid, Wide' END AS photo,
         CASE WHEN doc_id % 17 <> 4 AND (doc_id % 2 = 1 OR doc_id % 13 = 1) THEN 'flat drawing' END AS art_style,
         CASE WHEN doc_id % 2 = 0 THEN 'photograph' ELSE 'illustration' END AS medium
  FROM documents)"""


def captions(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """doc_id, lang, source, text, id, caption. Dealt to all tasks, unless what follows is short for each row or moves it anyway."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    docs = spread(docs) if dealt else docs
    ls, n = F.split("text", "\n", -1), F.col("doc_id")
    marked = lambda x: x.rlike("[0-9:]")
    element = lambda x: F.struct(F.when(x.contains("$$$"), "mark").when(marked(x), "text").otherwise("obj").alias("type"), F.when(marked(x), x).alias("text"), x.alias("desc"))
    both, neither = n % 13 == 1, n % 17 == 4
    style = F.struct(
        F.concat("source", F.lit(", "), "lang").alias("aesthetics"),
        F.when(n % 3 == 0, "soft light, Dusk").alias("lighting"),
        F.when(~neither & ((n % 2 == 0) | both), "candid, Wide").alias("photo"),
        F.when(n % 2 == 0, "photograph").otherwise("illustration").alias("medium"),
        F.when(~neither & ((n % 2 == 1) | both), "flat drawing").alias("art_style"),
    )
    deep = F.struct(F.get(ls, F.lit(1)).alias("background"), F.transform(F.slice(ls, F.lit(3), F.greatest(F.size(ls), F.lit(1))), element).alias("elements"))
    row_id = F.concat_ws("_", "lang", "source", F.lpad(n.cast("string"), 6, "0"))
    return docs.select("*", row_id.alias("id"), F.struct(F.get(ls, F.lit(0)).alias("high_level_description"), style.alias("style_description"), deep.alias("compositional_deconstruction")).alias("caption"))


# --- selections


def head_noun(x: str) -> str:
    short = f"lower(regexp_replace({joined(ws(f"regexp_replace(trim({x}), '(?i)^(a|an|the)\\s+', '')") + '[1:3]')}, '[,.]+$', ''))"
    return f"CASE WHEN {short} = '' THEN '{facts.NOTHING}' ELSE {short} END"


def later_facts(x: str) -> str:
    """The parts after the first, which may be blank where a part is marks alone."""
    parts = f"list_filter(list_transform(string_split_regex(coalesce({x}, ''), '[,;]| with | featuring '), lambda c: trim(c)), lambda c: c <> '')"
    return f"list_transform({parts}[2:], lambda c: lower({joined(ws("regexp_replace(c, '\\.+$', '')") + '[1:6]')}))"


def fact_texts(x: str) -> str:
    return f"list_filter(list_concat([{head_noun(f"coalesce({x}, '')")}], {later_facts(x)})[1:8], lambda t: trim(t) <> '')"


def style_parts(x: str) -> str:
    return f"list_filter(list_transform(string_split(lower(coalesce({x}, '')), ','), lambda p: trim(p)), lambda p: p <> '')"


def _hits(words: str) -> str:
    return f"regexp_matches(e.desc, '{facts.whole_words(words)}')"


_PERSON, _BACK, _VAGUE = _hits(facts.PERSON_WORDS), _hits(facts.BACKDROP_WORDS), _hits(facts.VAGUE_WORDS)
_NAMES = facts.GROUP_NAMES

INPUTS = f"""inputs AS (
  SELECT *, [{head_noun('high')}] AS theme, CASE WHEN trim(coalesce(ground, '')) <> '' THEN {fact_texts('ground')} ELSE [] END AS bg,
         list_filter([{{'field': 'photo', 'facts': {style_parts('photo')}}}, {{'field': 'art_style', 'facts': {style_parts('art_style')}}}, {{'field': 'lighting', 'facts': {style_parts('lighting')}}}, {{'field': 'aesthetics', 'facts': {style_parts('aesthetics')}}}], lambda s: len(s.facts) > 0) AS style,
         list_filter(list_transform(es, lambda e, i: CASE WHEN {_PERSON} THEN i END), lambda i: i IS NOT NULL) AS people,
         list_filter(list_transform(es, lambda e, i: CASE WHEN NOT {_PERSON} AND {_BACK} THEN i END), lambda i: i IS NOT NULL) AS back,
         list_filter(list_transform(es, lambda e, i: CASE WHEN NOT {_PERSON} AND NOT {_BACK} THEN i END), lambda i: i IS NOT NULL) AS other,
         coalesce(list_bool_or(list_transform(es, lambda e: {_VAGUE})), false) AS vague,
         list_transform(es, lambda e: {fact_texts('e.desc')}) AS fs
  FROM caps),
grouped AS (
  SELECT *, list_filter([
      CASE WHEN len(other) > 0 THEN {{'name': '{_NAMES['main']}', 'members': other[1:3], 'card': 'exact:' || least(len(other), 3)}} END,
      CASE WHEN len(people) > 0 THEN {{'name': '{_NAMES['people']}', 'members': people, 'card': CASE WHEN vague THEN 'vague' ELSE 'exact:' || len(people) END}} END,
      CASE WHEN len(other) > 3 THEN {{'name': '{_NAMES['others']}', 'members': other[4:], 'card': 'vague'}} END,
      CASE WHEN len(back) > 0 THEN {{'name': '{_NAMES['backdrop']}', 'members': back, 'card': 'vague'}} END], lambda g: g IS NOT NULL) AS found
  FROM inputs),
sel AS (
  SELECT *, list_transform(CASE WHEN len(found) > 0 THEN found ELSE [{{'name': '{_NAMES['main']}', 'members': []::BIGINT[], 'card': 'vague'}}] END,
           lambda g: {{'name': g.name, 'card': g.card, 'n': TRY_CAST(regexp_extract(g.card, '^exact:([0-9]+)$', 1) AS INT), 'elements': list_transform(g.members, lambda m: fs[m])}}) AS groups
  FROM grouped)"""


def selectable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """captions() with decomposition, sel_input and selection."""
    rows = curation.selectable(curation.decomposed(curation.numbered(captions(spark, sf_dir))))
    return once(rows, selection=selection(F.col("sel_input"), F.col("doc_id")))


def selection(sel_input: Column, n: Column) -> Column:
    """The rules' selection with faults: a strange fact, a group that the next level lacks, style where none may be, a missing level."""
    s = curation.rule_selection(sel_input)
    last = F.transform(F.slice(sel_input["groups"], -1, 1), lambda g: F.struct(g["name"].alias("name"), F.slice(F.flatten(g["elements"]), 1, 1).alias("facts")))
    short = s["short"].withField("groups", F.when(n % 11 == 5, last).otherwise(s["short"]["groups"])).withField("style", F.when(n % 5 == 1, sel_input["style"]).otherwise(s["short"]["style"]))
    medium = s["medium"].withField("background", F.when(n % 7 == 3, F.concat(s["medium"]["background"], F.array(F.lit("strange")))).otherwise(s["medium"]["background"]))
    return F.struct(short.alias("short"), medium.alias("medium"), F.when(n % 19 != 2, s["long"]).alias("long"))


def _dd(x: str) -> str:
    return f"list_filter({x}, lambda y, i: list_position({x}, y) = i)"


CHOICES = f"""choices AS (
  SELECT *, list_transform(CASE WHEN doc_id % 11 = 5 THEN groups[-1:] ELSE groups[1:1] END, lambda g: {{'name': g.name, 'card': g.card, 'n': g.n, 'elements': g.elements, 'facts': flatten(g.elements)[1:1]}}) AS short_g,
         CASE WHEN doc_id % 5 = 1 THEN style ELSE style[1:0] END AS short_s,
         list_transform(groups[1:2], lambda g: {{'name': g.name, 'card': g.card, 'n': g.n, 'elements': g.elements, 'facts': {_dd('flatten(g.elements)[1:2]')}}}) AS medium_g, bg[1:1] AS medium_b, doc_id % 7 = 3 AS medium_strange,
         list_transform(groups, lambda g: {{'name': g.name, 'card': g.card, 'n': g.n, 'elements': g.elements, 'facts': {_dd('flatten(g.elements)')}}}) AS long_g, {_dd('bg')} AS long_b, list_transform(style, lambda s: {{'field': s.field, 'facts': {_dd('s.facts')}}}) AS long_s, doc_id % 19 <> 2 AS long_there
  FROM sel)"""


def _view(level: str, ground: str, style: str, medium: str) -> str:
    """The checklist of a level: a silent group says its name."""
    said = f"flatten(list_transform({level}_g, lambda g: CASE WHEN len(g.facts) = 0 THEN [g.name] ELSE g.facts END))"
    return f"list_concat(list_concat(list_concat(theme, {said}), list_concat({ground}, {style})), {medium})"


VIEWS = f"""raw_views AS (
  SELECT *, {_view('short', "[]::VARCHAR[]", "flatten(list_transform(short_s, lambda s: " + _dd('s.facts') + "))", "[]::VARCHAR[]")} AS short_r, {_view('medium', 'medium_b', "[]::VARCHAR[]", "[]::VARCHAR[]")} AS medium_r, {_view('long', 'long_b', "flatten(list_transform(long_s, lambda s: s.facts))", "[medium]")} AS long_r
  FROM choices),
views AS (SELECT *, {_dd('short_r')} AS short_c, {_dd('medium_r')} AS medium_c, {_dd('long_r')} AS long_c FROM raw_views),
counted AS (
  SELECT *, coalesce(list_sum(list_transform(theme, lambda x: {wc('x')})), 0) AS theme_w,
         (list_sum(list_transform(short_c, lambda x: {wc('x')})) - theme_w)::BIGINT AS short_w, (list_sum(list_transform(medium_c, lambda x: {wc('x')})) - theme_w)::BIGINT AS medium_w, (list_sum(list_transform(long_c, lambda x: {wc('x')})) - theme_w)::BIGINT AS long_w,
         coalesce(list_sum(list_transform(short_g, lambda g: len(list_filter(g.facts, lambda f: NOT list_contains(list_transform(list_filter(g.elements, lambda e: len(e) > 0), lambda e: e[1]), f))))), 0)::BIGINT + greatest(len(short_g) - 1, 0) AS ideas,
         len(list_filter(short_g, lambda g: len(list_filter(medium_g, lambda h: h.name = g.name AND len(list_filter(g.facts, lambda f: NOT list_contains(h.facts, f))) = 0)) = 0)) AS short_lost_medium,
         len(list_filter(short_g, lambda g: len(list_filter(long_g, lambda h: h.name = g.name AND len(list_filter(g.facts, lambda f: NOT list_contains(h.facts, f))) = 0)) = 0)) AS short_lost_long,
         len(list_filter(short_s, lambda s: len(list_filter(long_s, lambda h: h.field = s.field)) = 0)) AS short_style_lost_long,
         len(list_filter(medium_g, lambda g: len(list_filter(long_g, lambda h: h.name = g.name AND len(list_filter(g.facts, lambda f: NOT list_contains(h.facts, f))) = 0)) = 0)) + CASE WHEN len(list_filter(medium_b, lambda f: NOT list_contains(long_b, f))) > 0 THEN 1 ELSE 0 END AS medium_lost_long
  FROM views),
judged AS (
  SELECT *, short_w <= 20 AND len(short_s) = 0 AND ideas <= 2 AS short_ok, medium_w <= 55 AND NOT medium_strange AS medium_ok, long_there AS long_ok,
         medium_ok AND (NOT long_ok OR medium_lost_long = 0) AS keep_medium,
         short_ok AND CASE WHEN keep_medium THEN short_lost_medium + len(short_s) = 0 WHEN long_ok THEN short_lost_long + short_style_lost_long = 0 ELSE true END AS keep_short
  FROM counted)"""

SELECTING = f"WITH {CAPS}, {INPUTS}, {CHOICES}, {VIEWS}"

# --- prompts and verdicts

PROMPTS = f"""prompts AS (
  SELECT caps.doc_id, id, lang, source, ['short', 'medium', 'long'][1 + doc_id % 3] AS level, {joined(ws("replace(text, chr(10), ' ')"))} AS prompt, labels.quality, labels.toxic
  FROM caps LEFT JOIN labels USING (doc_id))"""


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt a document: its words; with its level, and its labels where it has some."""
    from ..functions.text import words

    rows = captions(spark, sf_dir, dealt=False).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    level = F.get(F.array(F.lit("short"), F.lit("medium"), F.lit("long")), (F.col("doc_id") % 3).cast("int"))
    return rows.select("doc_id", "id", "lang", "source", level.alias("level"), F.array_join(words(F.col("text")), " ").alias("prompt"), "quality", "toxic")


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """prompts() with a judge's raw answer for labelled rows: low quality misses a core fact, toxic rows add a hard extra, others a minor or soft one."""
    p = prompts(spark, sf_dir)
    n, word = F.col("doc_id"), F.coalesce(F.get(F.split("prompt", " "), F.lit(0)), F.lit(""))
    item = lambda key, text, level: F.to_json(F.struct(text.alias(key), F.lit(level).alias("muc_do")))
    quoted = lambda text: F.to_json(F.array(text))
    missing = F.when(F.col("quality") == 0, F.when(n % 2 == 0, quoted(word)).otherwise(F.concat(F.lit("["), item("menh_de", word, "cot_loi"), F.lit("]")))).when(n % 4 == 0, F.concat(F.lit("["), item("menh_de", F.col("source"), "PHU "), F.lit("]"))).otherwise("[]")
    extra = F.when(F.col("toxic") == 1, F.concat(F.lit("["), item("thong_tin", F.col("lang"), "them_vat_the"), F.lit("]"))).when(n % 5 == 0, F.concat(F.lit("["), item("thong_tin", F.col("source"), "cam_nhan"), F.lit(', "", " "]'))).otherwise("[]")
    judged = F.col("quality").isNotNull()
    return p.withColumns({"raw_missing": F.when(judged, missing), "raw_extra": F.when(judged, extra), "required": F.when(n % 6 == 0, F.array(word)).otherwise(F.array().cast("array<string>"))})


VERDICTS = f"""verdicts AS (
  SELECT *, coalesce(string_split(prompt, ' ')[1], '') AS w, quality IS NOT NULL AS is_judged,
         CASE WHEN quality = 0 AND w <> '' THEN 1 ELSE 0 END AS n_core, CASE WHEN quality <> 0 AND doc_id % 4 = 0 THEN 1 ELSE 0 END AS n_minor,
         CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS n_hard, CASE WHEN toxic <> 1 AND doc_id % 5 = 0 THEN 1 ELSE 0 END AS n_soft,
         doc_id % 6 = 0 AND ((n_core = 1) OR (n_minor = 1 AND source = w)) AS lost,
         is_judged AND NOT lost AND n_core = 0 AND n_hard = 0 AS is_passed
  FROM prompts)"""
GATE = f"WITH {CAPS}, {PROMPTS}, {VERDICTS}"
