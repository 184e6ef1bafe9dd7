"""The quality gate: read a judge's verdict, decide, report; corrections and their report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import reason_label, squeeze, word_count

# Severities.
CORE, MINOR = "cot_loi", "phu"
HARD, SOFT = "them_vat_the", "cam_nhan"


def _items(raw: Column, text_key: str, strict: str, lenient: str) -> Column:
    """Judge items from JSON: an object's text and severity, or a bare string; whatever is not the lenient severity is the strict one; blank ones go."""
    each = F.from_json(raw, "array<string>")
    # A string element comes as its text, an object as its JSON.
    text = lambda x: F.trim(F.when(F.json_object_keys(x).isNotNull(), F.coalesce(F.get_json_object(x, f"$.{text_key}"), F.lit(""))).otherwise(x))
    level = lambda x: F.when(F.lower(F.trim(F.get_json_object(x, "$.muc_do"))) == lenient, lenient).otherwise(strict)
    return F.filter(F.transform(F.coalesce(each, F.array().cast("array<string>")), lambda x: F.struct(text(x).alias(text_key), level(x).alias("muc_do"))), lambda i: i[text_key] != "")


def missing_items(raw: Column) -> Column:
    return _items(raw, "menh_de", CORE, MINOR)


def extra_items(raw: Column) -> Column:
    return _items(raw, "thong_tin", HARD, SOFT)


def required_facts(listed: Column, single: Column | None = None) -> Column:
    """A row's required facts: the list, or the one subject that older rows have, or none."""
    none = F.array().cast("array<string>")
    old = F.when(F.coalesce(single, F.lit("")) != "", F.array(single)).otherwise(none) if single is not None else none
    return F.when(F.size(listed) > 0, listed).otherwise(old)


def decide(missing: Column, extra: Column, required: Column | None = None, max_missing: int = 0) -> Column:
    """struct<passed, reasons, ...>: a lost theme fact rejects, whatever its severity; only else do too many core facts; a hard extra
    rejects besides; minor misses and soft extras never do."""
    pick = lambda items, key, level=None: F.transform(items if level is None else F.filter(items, lambda i: i["muc_do"] == level), lambda i: i[key])
    core, hard = pick(missing, "menh_de", CORE), pick(extra, "thong_tin", HARD)
    lost = F.filter(required, lambda f: F.array_contains(pick(missing, "menh_de"), f)) if required is not None else F.array().cast("array<string>")
    reasons = F.array_compact(
        F.array(
            F.when(F.size(lost) > 0, F.concat(F.lit("theme lost: "), F.array_join(lost, "; "))).when(F.size(core) > max_missing, F.concat(F.lit("missing "), F.size(core).cast("string"), F.lit(" core facts"))),
            F.when(F.size(hard) > 0, F.concat(F.lit("adds "), F.size(hard).cast("string"), F.lit(" facts"))),
        )
    )
    return F.struct(
        (F.size(reasons) == 0).alias("passed"),
        reasons.alias("reasons"),
        pick(missing, "menh_de").alias("missing"),
        core.alias("missing_cot_loi"),
        pick(missing, "menh_de", MINOR).alias("missing_phu"),
        pick(extra, "thong_tin").alias("extra"),
        hard.alias("extra_them_vat_the"),
        pick(extra, "thong_tin", SOFT).alias("extra_cam_nhan"),
    )


def with_verdicts(rows: DataFrame, verdicts: DataFrame, keys: list[str], bypass: bool = False) -> DataFrame:
    """rows with their verdict's missing and extra. Rows that were not judged stay, both null; when the gate is bypassed they count as
    faultless, while verdicts that are there still hold."""
    out = rows.join(verdicts, keys, "left")
    if bypass:
        out = out.withColumns({"missing": F.coalesce("missing", F.array().cast(schemas.MISSING)), "extra": F.coalesce("extra", F.array().cast(schemas.EXTRA))})
    return out


def report(decided: DataFrame, decision: str = "decision") -> DataFrame:
    """One row: input, judged (decision not null), passed, rejected, pass rate of the judged (4 decimals), passed with minor misses and with soft extras."""
    d = F.col(decision)
    judged, passed = d.isNotNull(), F.coalesce(d["passed"], F.lit(False))
    n = lambda c: F.count_if(c)
    return decided.agg(
        F.count("*").alias("n_input"),
        n(judged).alias("n_judged"),
        n(passed).alias("n_passed"),
        n(judged & ~passed).alias("n_rejected"),
        F.coalesce(F.round(n(passed) / F.nullif(n(judged), F.lit(0)), 4), F.lit(0.0)).alias("pass_rate"),
        n(passed & (F.size(d["missing_phu"]) > 0)).alias("n_passed_with_minor"),
        n(passed & (F.size(d["extra_cam_nhan"]) > 0)).alias("n_passed_with_soft"),
    )


def report_by_level(decided: DataFrame, level: str = "detail_level", decision: str = "decision") -> DataFrame:
    """Per level: all its rows, those passed, and their share of all rows (4 decimals), judged or not."""
    passed = F.count_if(F.coalesce(F.col(decision)["passed"], F.lit(False)))
    return decided.groupBy(level).agg(F.count("*").alias("n"), passed.alias("passed"), F.round(passed / F.count("*"), 4).alias("pass_rate"))


def top_texts(decided: DataFrame, field: str, n: int = 30, decision: str = "decision", place: str = "doc_id") -> DataFrame:
    """The n most frequent texts of a decision's list over judged rows, passed or not; ties to what was seen first."""
    each = decided.select(F.col(place).alias("_at"), F.posexplode(F.col(decision)[field]).alias("_pos", "text"))
    counted = each.groupBy("text").agg(F.count("*").alias("n"), F.min(F.struct("_at", "_pos")).alias("_first"))
    return counted.orderBy(F.desc("n"), "_first").limit(n).select("text", "n")


def reason_counts(decided: DataFrame, decision: str = "decision") -> DataFrame:
    """Rejection reasons without their details, most frequent first."""
    each = decided.select(F.explode(F.col(decision)["reasons"]).alias("r")).select(reason_label(F.col("r")).alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def corrected(rejected: DataFrame, prompt: str = "user_prompt", answer: str = "corrected_prompt") -> DataFrame:
    """Rejected rows with a corrected prompt in place of theirs, its words counted anew and the original kept."""
    new = squeeze(F.col(answer))
    return rejected.withColumns({"original_prompt": F.col(prompt), prompt: new, "n_words": word_count(new), "corrected": F.lit(True)}).drop(answer)


def after_correction(rejected: DataFrame, attempts: DataFrame, keys: list[str], prompt: str = "user_prompt") -> tuple[DataFrame, DataFrame]:
    """Rejected rows that were corrected and judged again, as (recovered, rejected_final). attempts: keys, corrected_prompt and decision. A recovered row has the new prompt in place of
    its own; another keeps its own, with attempted_prompt and reject_after_retry. Rows without an attempt, or with a blank one, are in neither."""
    tried = rejected.join(attempts.where(F.trim("corrected_prompt") != ""), keys)
    good = corrected(tried.where("decision.passed"), prompt).drop("decision")
    bad = tried.where(~F.coalesce(F.col("decision.passed"), F.lit(False)))
    return good, bad.withColumns({"attempted_prompt": squeeze(F.col("corrected_prompt")), "reject_after_retry": F.col("decision")}).drop("corrected_prompt", "decision")


def correction_report(attempts: DataFrame, passed: str = "passed") -> DataFrame:
    ok = F.count_if(F.coalesce(F.col(passed), F.lit(False)))
    return attempts.agg(F.count("*").alias("n_attempted"), ok.alias("n_recovered"), (F.count("*") - ok).alias("n_rejected_final"), F.coalesce(F.round(ok / F.nullif(F.count("*"), F.lit(0)), 4), F.lit(0.0)).alias("recovery_rate"))
