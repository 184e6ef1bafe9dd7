import random
import unicodedata

from pyspark.sql import functions as F

from quillmill.functions import text


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "s string").select(make(F.col("s")).alias("x")).first()["x"]


def test_accents_fold_as_unicode_decomposition_does(spark):
    letters = [chr(c) for c in range(0xC0, 0x1EFF) if unicodedata.category(chr(c)) in ("Ll", "Lu") and 0x250 > c or 0x1E00 <= c < 0x1EFF]
    want = ["".join(x for x in unicodedata.normalize("NFD", c.replace("đ", "d").replace("Đ", "D")) if unicodedata.category(x) != "Mn") for c in letters]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(letters)], "i int, s string").select("i", text.fold_accents(F.col("s")).alias("x"))
    got = {r["i"]: r["x"] for r in rows.collect()}
    assert [got[i] for i in range(len(letters))] == want
    assert one(spark, "ấm trà Đông é", text.fold_accents) == "am tra Dong e"


def test_words_know_unicode_white_space(spark):
    assert one(spark, " a b \t c\n", text.word_count) == 3
    assert one(spark, None, text.word_count) == 0


def test_slugs(spark):
    assert one(spark, "am_tich_000755__short", text.topic_slug) == "am_tich"
    assert one(spark, "__x", text.slug_words) == []


def test_quotes(spark):
    for raw, want in (('  "a  b" ', "a b"), ("“x”", "x"), ("'“x”'", "x"), ('"', '"'), ('""', ""), ("a", "a"), ("“x", "“x")):
        assert one(spark, raw, text.unquoted) == want


def test_counts(spark):
    assert [one(spark, c, text.count_fact) for c in ("exact:3", "exact:1", "exact:abc", "vague", None)] == ["số lượng: 3", None, None, None, None]
    assert [one(spark, c, text.is_plural) for c in ("exact:3", "exact:1", "exact:abc", "vague")] == [True, False, False, True]


def test_leading_phrase(spark):
    say = lambda key, s: one(spark, s, lambda c: text.leading_phrase(F.lit(key), c))
    assert say("banh_mi_viet_nam_000001", "Một ổ BÁNH MÌ nóng") == "banh mi"
    assert say("lan_000001", "hoa lan") == "lan"
    assert say("lan_000001", "hoa lanh") is None
    assert say("banh_mi_000001", "banh min") is None
    assert say("trung_tam_thanh_pho_ho_chi_min_01", "Trung tâm thành phố Hồ Chí Minh") == "trung tam thanh pho ho chi min"
    assert say("_000001", "x") is None


def test_draws_are_even(spark):
    n = 4000
    rows = spark.range(n).select(text.unit_draw(F.lit("7"), F.col("id").cast("string")).alias("u"))
    low, mean = rows.agg(F.count_if(F.col("u") < 0.6), F.avg("u")).first()
    assert abs(low / n - 0.6) < 0.03 and abs(mean - 0.5) < 0.03


def test_reason_label(spark):
    assert one(spark, "missing 3 core facts: a 4 b", text.reason_label) == "missing core facts"


def test_percentiles_take_the_lower_rank(spark):
    from quillmill.functions import stats

    rng = random.Random(1)
    values = [rng.randrange(50) for _ in range(37)]
    row = stats.percentiles(spark.createDataFrame([(v,) for v in values], "v int"), F.col("v")).first()
    ordered = sorted(values)
    for name, q in stats.QUANTILES.items():
        assert row[name] == ordered[int(q * (len(ordered) - 1))]
    assert stats.percentiles(spark.createDataFrame([(v,) for v in range(1, 8)], "v int"), F.col("v")).first()["p90"] == 6
    assert stats.length_summary(spark.createDataFrame([("a", v) for v in (4, 1, 3, 2)], "k string, v int"), F.col("v"), ["k"]).first()["median"] == 3
    assert stats.percentiles(spark.createDataFrame([], "v int"), F.col("v")).first()["p50"] is None
