"""Text expressions: Column in, Column out, all of them JVM-side."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Every precomposed Latin letter whose decomposition is one base letter and marks, and that base letter; d with stroke besides."""
    pairs = {"đ": "d", "Đ": "D"}
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(point)) if unicodedata.category(c) != "Mn")
        if len(bare) == 1 and bare != chr(point):
            pairs[chr(point)] = bare
    return "".join(pairs), "".join(pairs.values())


ACCENTED, BARE = _accent_table()


def fold_accents(text: Column) -> Column:
    """Latin letters without their marks, composed or combining."""
    return F.translate(F.regexp_replace(text, "\\p{Mn}+", ""), ACCENTED, BARE)


def words(text: Column) -> Column:
    """White-space-separated words; the white space is Unicode's."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "(?U)\\s+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def total_words(items: Column) -> Column:
    """Words of all texts of a list: those of the texts joined, cut in one go."""
    return F.when(items.isNotNull(), word_count(F.array_join(items, " ")))


def squeeze(text: Column) -> Column:
    """Words with one blank between."""
    return F.array_join(words(text), " ")


def topic_slug(key: Column) -> Column:
    """The id, without a level after '__', and without its running number."""
    return F.regexp_replace(F.substring_index(key, "__", 1), "_\\d+$", "")


def slug_words(key: Column) -> Column:
    return F.filter(F.split(topic_slug(key), "_"), lambda w: w != "")


def composite_key(row_id: Column, level: Column) -> Column:
    return F.concat_ws("__", row_id, level)


def exact_count(cardinality: Column) -> Column:
    """n of 'exact:n', else null."""
    return F.regexp_extract(cardinality, "^exact:\\s*([+-]?\\d+)\\s*$", 1).try_cast("int")


def count_fact(cardinality: Column) -> Column:
    """The fact that states a count of two or more, else null."""
    n = exact_count(cardinality)
    return F.when(n >= 2, F.concat(F.lit("số lượng: "), n.cast("string")))


def is_plural(cardinality: Column) -> Column:
    return F.coalesce((cardinality == "vague") | (exact_count(cardinality) >= 2), F.lit(False))


def original_name(label: Column) -> Column:
    """A group's name without the number that told it from another of the same name."""
    return F.regexp_replace(label, " \\[\\d+\\]$", "")


def unquoted(text: Column) -> Column:
    """White space squeezed and one layer of quotation marks around the whole taken off."""
    return _curly(_straight(squeeze(text)))


def _inside(s: Column) -> Column:
    return F.trim(F.substring(s, F.lit(2), F.greatest(F.char_length(s) - 2, F.lit(0))))


def _straight(s: Column) -> Column:
    first = F.substring(s, 1, 1)
    same = (F.char_length(s) >= 2) & (first == F.right(s, F.lit(1))) & first.isin('"', "'", "“")
    return F.when(same, _inside(s)).otherwise(s)


def _curly(s: Column) -> Column:
    return F.when(s.startswith("“") & s.endswith("”"), _inside(s)).otherwise(s)


def phrase_form(text: Column) -> Column:
    """Folded, lower-cased, and every run of other characters than letters and digits one blank."""
    return F.trim(F.regexp_replace(F.lower(fold_accents(text)), "[^a-z0-9]+", " "))


#: Slugs are cut at so many characters, so that a longer one's last word may be the beginning of a word.
CUT_SLUG = 30


def leading_phrase(key: Column, text: Column) -> Column:
    """The longest run of the id's leading words, two at least (one if it has but one), that the text has on word boundaries; else null."""
    parts, padded = slug_words(key), F.concat(F.lit(" "), phrase_form(text), F.lit(" "))
    n = F.size(parts)
    whole = lambda k: F.array_join(F.slice(parts, F.lit(1), k), " ")
    cut = (F.char_length(topic_slug(key)) >= CUT_SLUG)
    found = lambda k: padded.contains(F.concat(F.lit(" "), whole(k), F.when(cut & (k == n), F.lit("")).otherwise(F.lit(" "))))
    lengths = F.when(n > 0, F.sequence(n, F.least(n, F.lit(2)), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.get(F.transform(F.filter(lengths, found), whole), F.lit(0))


def reason_label(reason: Column) -> Column:
    """A reason without its details: what stands before a colon, numbers taken out."""
    return F.trim(F.regexp_replace(F.substring_index(reason, ":", 1), "\\s*\\d+\\s+", " "))


def percent(part: Column, total: Column) -> Column:
    return F.when(total > 0, F.format_string("%.1f%%", 100.0 * part / total)).otherwise("-")


def shortened(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone: the same in any engine, partition or run."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def seeded_rank(seed: int, key: Column) -> Column:
    """A sort key that shuffles by a seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key).cast("binary"))
