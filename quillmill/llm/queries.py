"""The queries of this subpackage, one for each operator, and their SQL where SQL can tell the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from public_tokenizers import path as tokenizer_path

from . import ann, decontaminate, fixity, linededup, lm, packing, piecewise, quality, repair, simhash, tokencount, toxicity, whitening
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.scores(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "n_backed_off", F.round(F.col("log_score") / F.greatest(F.col("n_words"), F.lit(1)), 6).alias("mean_log_score"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the WARC files of the pages against a second copy, indexed from its own bytes, in which some records have rotted and some are lost, so that those after them have moved."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    luck = F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2)
    rotten = F.when(luck < "03", F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    index = lambda copy: fixity.warc_index(copy, F.floor(F.col("page_id") / 2000), ["page_id"], fixity.warc_record(F.col("url"), F.col("html")), F.col("page_id"))
    found = fixity.audit(index(pages), index(pages.where(luck != "ff").withColumn("html", rotten)))
    return found.select(F.col("file").cast("long").alias("warc_file"), "offset", "length", F.col("name").cast("long").alias("page_id"), "status")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(*repair.parts(repair.damaged(table(spark, sf_dir, "conversations"))))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.neighbours(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_toxicity,
        op3_lm_score,
        op4_line_dedup,
        op5_token_counts,
        op6_ann,
        op7_warc_fixity,
        op8_decontamination,
        op9_packing,
        op10_quality_resampling,
        op11_whitening,
        op12_conversation_repair,
        op13_fingerprints,
    )
}

_KEY = "translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_RECORD = "'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || {} || chr(13) || chr(10) || chr(13) || chr(10)"

ORACLE = {
    "op12_conversation_repair": f"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
lucky AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(k)), lambda j: ascii(substring(k, j + 1, 1))::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS luck FROM named, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN luck = 4 THEN 'user' ELSE role END AS role, CASE WHEN luck = 1 THEN '' WHEN luck = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE luck WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM lucky),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, left(role, 1) AS initial, trim(text, {_WHITE}) AS bare FROM damaged),
told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier FROM placed),
faulty AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN again THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM told),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
                  count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations),
grammar(a, b, initial) AS (VALUES ('dialog', 'turns', 's'), ('dialog', 'answer', 'u'), ('turns', 'answer', 'u'), ('answer', 'rest', 'a'), ('rest', 'answer', 'u')),
inserts(a, b, times) AS (VALUES ('dialog', 'dialog', 0), ('turns', 'turns', 0), ('answer', 'answer', 0), ('rest', 'rest', 0), ('dialog', 'answer', 1), ('dialog', 'rest', 2), ('turns', 'answer', 1), ('turns', 'rest', 2), ('answer', 'rest', 1), ('rest', 'answer', 1)),
edits(a, b, initial, letter) AS (SELECT a, b, initial, 'K' FROM grammar UNION ALL SELECT a, b, NULL, 'R' FROM grammar WHERE initial <> 's' UNION ALL SELECT a, a, NULL, 'D' FROM inserts WHERE a = b),
chart AS (
  SELECT conv_id, 0::BIGINT AS pos, b AS expected, {{'cost': 5 * times, 'audit': repeat('I', times)}} AS v FROM every, inserts WHERE a = 'dialog'
  UNION ALL
  SELECT conv_id, pos, expected, min(v) FROM (
    SELECT c.conv_id, r.pos, i.b AS expected, {{'cost': c.v.cost + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.letter <> 'D' AND r.fault = 3 THEN 5 ELSE 0 END + 5 * i.times, 'audit': c.v.audit || e.letter || repeat('I', i.times)}} AS v
    FROM chart c JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.pos = c.pos + 1
    JOIN edits e ON e.a = c.expected AND (e.letter = 'D' OR r.fault NOT IN (1, 2) AND (e.letter = 'R' OR e.initial = r.initial)) JOIN inserts i ON i.a = e.b)
  GROUP BY conv_id, pos, expected),
best AS (SELECT c.conv_id, min(c.v) AS v FROM chart c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id WHERE c.pos = coalesce(n.n, 0) AND c.expected IN ('dialog', 'rest') GROUP BY c.conv_id),
letters AS (SELECT conv_id, unnest(string_split(v.audit, '')) AS letter, generate_subscripts(string_split(v.audit, ''), 1) AS k, length(replace(v.audit, 'D', '')) AS total FROM best WHERE v.audit <> ''),
steps AS (SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS pos, count(*) FILTER (WHERE letter <> 'D') OVER w - 1 AS place FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
lines AS (SELECT s.conv_id, s.k, CASE WHEN letter = 'K' THEN r.role WHEN (place - total % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE r.text END AS line
          FROM steps s LEFT JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.pos = s.pos WHERE letter <> 'D'),
whole AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS text FROM lines GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       b.v.cost::BIGINT AS cost, b.v.audit AS audit, sha256(coalesce(w.text, '')) AS repaired_sha256
FROM best b LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM b.conv_id""",
    "op7_warc_fixity": f"""
WITH records AS (SELECT page_id, {_RECORD.format("coalesce(html, '')")} AS a, {_RECORD.format("'#' || substring(html, 2)")} AS b, left(md5(page_id::VARCHAR), 2) AS luck FROM pages),
placed AS (SELECT *, page_id // 2000 AS warc_file, strlen(a) AS length, coalesce(sum(strlen(a)) OVER (PARTITION BY page_id // 2000 ORDER BY page_id, sha256(a) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM records)
SELECT warc_file, "offset", length, page_id, CASE WHEN luck = 'ff' THEN 'missing' ELSE 'changed' END AS status
FROM placed WHERE luck = 'ff' OR luck < '03' AND a <> b""",
    "op3_lm_score": """
WITH words AS (
  SELECT row, doc_id, w, row_number() OVER (PARTITION BY row ORDER BY pos) AS pos
  FROM (SELECT row, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
        FROM (SELECT row_number() OVER () AS row, doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') AS ws FROM documents))
  WHERE w <> ''),
pairs AS (SELECT *, lag(w) OVER (PARTITION BY row ORDER BY pos) AS before FROM words),
one AS (SELECT w, count(*) AS n FROM words GROUP BY w),
two AS (SELECT before, w, count(*) AS n FROM pairs WHERE before IS NOT NULL GROUP BY before, w),
total AS (SELECT count(*) AS n FROM words),
scored AS (
  SELECT p.row, two.n >= 2 AS hit,
         CASE WHEN two.n >= 2 THEN ln(two.n) - ln(ctx.n) WHEN p.before IS NULL THEN ln(one.n) - ln(total.n) ELSE ln(0.4) + ln(one.n) - ln(total.n) END AS s
  FROM pairs p JOIN one ON one.w = p.w CROSS JOIN total LEFT JOIN two ON two.before = p.before AND two.w = p.w LEFT JOIN one ctx ON ctx.w = p.before),
sums AS (SELECT row, count(*) AS n_words, count(*) FILTER (WHERE NOT coalesce(hit, false)) AS n_backed_off, sum(s) AS s FROM scored GROUP BY row)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backed_off, 0) AS n_backed_off, round(coalesce(s, 0.0) / greatest(coalesce(n_words, 1), 1), 6) AS mean_log_score
FROM (SELECT row_number() OVER () AS row, doc_id FROM documents) d LEFT JOIN sums USING (row)""",
    "op4_line_dedup": f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, l, {_KEY} AS k FROM lines),
rep AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.doc_id, pos, l, coalesce(rep.keeper <> keyed.doc_id, false) AS gone FROM keyed LEFT JOIN rep USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
