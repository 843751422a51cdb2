"""Readability, numbering and language measures as Column functions.

Null input gives null unless a docstring says otherwise.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioloom.functions.text import WS, round_half_up

# Abbreviations whose first stop ends no sentence.
ABBREVIATIONS = ("Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Sr.", "Jr.", "St.", "vs.", "etc.", "Vol.", "No.", "e.g.", "i.e.")
# Least score of each level.
CEFR = ((90, "A1"), (80, "A2"), (60, "B1"), (50, "B2"), (30, "C1"))
ROMAN = {name: n for n, name in enumerate("I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split(), 1)}


def syllables(word: Column) -> Column:
    """Syllables of a word by vowel runs."""
    w = F.regexp_replace(F.lower(word), "[^a-z]", "")
    n = F.regexp_count(w, F.lit("[aeiouy]+"))
    n = n - F.when(w.endswith("e") & (n > 1), 1).otherwise(0)
    n = n + F.when(w.rlike("[^aeiouy]le$"), 1).otherwise(0)
    n = n - F.when(w.rlike("[^td]ed$") & (F.length(w) > 3) & (n > 1), 1).otherwise(0)
    return F.when(F.length(w) <= 2, F.lit(1)).otherwise(F.greatest(n, F.lit(1))).cast("long")


def words(text: Column) -> Column:
    """Blank-delimited pieces with an ASCII letter."""
    return F.filter(F.split(text, rf"[{WS}]+"), lambda w: w.rlike("[a-zA-Z]"))


def sentences(text: Column) -> Column:
    """Pieces between runs of ``.!?``, the first stop of abbreviations left out; blank pieces dropped."""
    masked = reduce(lambda t, a: F.replace(t, F.lit(a), F.lit(a.replace(".", "\x01", 1))), ABBREVIATIONS, text)
    return F.filter(F.split(masked, r"[.!?]+"), lambda s: s.rlike(rf"[^{WS}]"))


def total_syllables(word_list: Column) -> Column:
    """Sum of syllables of an array of words."""
    return F.aggregate(word_list, F.lit(0).cast("long"), lambda acc, w: acc + syllables(w))


def flesch(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Reading ease, one decimal, within 0 to 100; 50 without words or sentences."""
    raw = F.lit(206.835) - F.lit(1.015) * (n_words / n_sentences) - F.lit(84.6) * (n_syllables / n_words)
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), round_half_up(raw * 10) / 10))
    return F.when((n_words > 0) & (n_sentences > 0), score).otherwise(F.lit(50.0))


def cefr(score: Column) -> Column:
    """Level of a reading ease score."""
    level = F.when(score.isNull(), None)
    for least, name in CEFR:
        level = level.when(score >= least, name)
    return level.otherwise("C2")


def difficulty(score: Column) -> Column:
    """100 - score, one decimal."""
    return round_half_up((F.lit(100) - score) * 10) / 10


def reading_minutes(n_words: Column, per_minute: int = 250) -> Column:
    """Whole minutes, at least one."""
    return F.greatest(F.lit(1), round_half_up(n_words / per_minute)).cast("long")


def chapter_number(title: Column) -> Column:
    """Number in ``Chapter 7``, ``Ch. 7`` or ``Chapter XIV`` (to XX); null if none."""
    arabic = F.coalesce(
        F.nullif(F.regexp_extract(title, r"(?i)(?<![A-Za-z0-9_])chapter\s+(\d+)(?![A-Za-z0-9_])", 1), F.lit("")),
        F.nullif(F.regexp_extract(title, r"(?i)(?<![A-Za-z0-9_])ch\.?\s+(\d+)(?![A-Za-z0-9_])", 1), F.lit("")),
    )
    roman = F.upper(F.regexp_extract(title, r"(?i)(?<![A-Za-z0-9_])chapter\s+(X{0,2}(?:IX|IV|V?I{0,3}))(?![A-Za-z0-9_])", 1))
    table = F.create_map(*[F.lit(x) for pair in ROMAN.items() for x in pair])
    return F.coalesce(arabic.try_cast("int"), F.try_element_at(table, roman))


def zh_sentences(text: Column) -> Column:
    """Non-blank pieces between Chinese sentence signs or line feeds."""
    return F.filter(F.split(text, r"[。！？；\n]+"), lambda s: s.rlike(rf"[^{WS}]"))


# Forms of Chinese chapter titles, first match decides.
ZH_PATTERNS = (
    ("numbered", r"第[一二三四五六七八九十百千\d]+[回章节篇卷集部]"),
    ("volume", r"卷[一二三四五六七八九十百千\d上中下]+"),
    ("section", r"篇[一二三四五六七八九十百千\d]+"),
    ("part", r"[上中下]篇"),
    ("auxiliary", r"序言?|引[言子]|前言|后记|跋|附录|楔子|引首|尾声"),
    ("cjk-numbered", r"[一二三四五六七八九十]+[、，]"),
    ("arabic-numbered", r"\d+[.、]"),
)


def zh_title_pattern(title: Column) -> Column:
    """Name of the first form found in a title; null if none."""
    t = title
    return reduce(lambda acc, p: acc.when(t.rlike(p[1]), p[0]), ZH_PATTERNS[1:], F.when(t.rlike(ZH_PATTERNS[0][1]), ZH_PATTERNS[0][0]))


def zh_difficulty(average_level: Column, unknown_share: Column, sentence_length: Column) -> Column:
    """0.4 level + 0.4 unknown words + 0.2 sentence length, each on 0 to 100, rounded and clamped."""
    raw = F.lit(0.4) * (average_level - 1) / 5 * 100 + F.lit(0.4) * unknown_share * 100 + F.lit(0.2) * F.least(F.lit(100.0), sentence_length / 40 * 100)
    return F.greatest(F.lit(0), F.least(F.lit(100), round_half_up(raw))).cast("long")


def guess_language(text: Column) -> Column:
    """Language of a short foreign phrase by its letters; Latin if none speaks for another."""
    return (
        F.when(text.rlike("[äöüßÄÖÜ]"), "de")
        .when(text.rlike("[ñáéíóú¿¡ÑÁÉÍÓÚ]"), "es")
        .when(text.rlike("[àâçèêëîïôùûüœÀÂÇÈÊËÎÏÔÙÛŒ]"), "fr")
        .when(text.rlike("[ìòÌÒ]"), "it")
        .otherwise("la")
    )


# Words that carry no meaning in titles.
STOP_WORDS = ("the", "a", "an", "of", "and", "or", "in", "on", "to", "for")


def title_tokens(title: Column) -> Column:
    """Distinct lower-case words of a title, without one-letter words and stop words."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(title), r"[;:,.'\"!?—–-]", " "), r"\s+", " "))
    return F.array_distinct(F.filter(F.split(plain, " "), lambda w: (F.length(w) > 1) & ~w.isin(*STOP_WORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens of two arrays; 0 if both are empty."""
    return F.when(F.size(F.array_union(a, b)) > 0, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def normalize_ascii(text: Column) -> Column:
    """Lower-case letters and digits separated by single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]+", " "), r"\s+", " "))


def normalize_compatible(text: Column) -> Column:
    """``normalize_ascii`` of the compatibility form (NFKC), which Spark has no function for (Arrow batches)."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    return normalize_ascii(run(text))


# Broad categories and the parts of subjects that speak for them; first match decides.
CATEGORIES = (
    ("Science Fiction", ("science fiction", "dystopi")), ("Fantasy", ("fantasy", "fairy tale")), ("Mystery & Detective", ("mystery", "detective")),
    ("Horror & Gothic", ("horror", "ghost", "gothic")), ("Romance", ("romance", "love stor")), ("Adventure", ("adventure",)), ("History", ("histor",)),
    ("Philosophy", ("philosophy", "ethics")), ("Science", ("science", "natural history", "biology", "physics")), ("Poetry", ("poetry", "poems")),
    ("Drama", ("drama", "plays", "comedy", "tragedy")), ("Religion", ("religion", "bible", "christian", "theolog")),
    ("Politics", ("political", "politics", "government")), ("Economics", ("economics", "commerce", "trade")),
    ("Children & Education", ("education", "children")), ("Biography", ("biography", "autobiograph", "memoir")), ("Travel", ("travel", "voyage")),
    ("War & Military", ("war", "military")), ("Humor & Satire", ("humor", "satir")),
)


def subject_category(subject: Column) -> Column:
    """Broad category of a subject heading; null if none."""
    s = F.lower(subject)
    out = F.when(s.contains("fiction") & ~s.contains("non-fiction") & ~s.contains("science fiction"), "Fiction")
    for name, parts in CATEGORIES:
        out = out.when(reduce(lambda x, y: x | y, [s.contains(p) for p in parts]), name)
    return out
