"""The common words of a corpus, by document frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least share of the documents that hold a common word.
COMMON_SHARE = 0.0005


def word_array(text: Column) -> Column:
    """The distinct words of a text in lower case: letter runs with inner apostrophes."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}]+(?:['\x{2019}][\p{L}]+)*"), F.lit(0)))


def common_words(texts: DataFrame, text: str = "text", min_share: float = COMMON_SHARE) -> frozenset[str]:
    """The words that at least ``min_share`` of the documents hold, counted over all of them.

    At most (mean distinct words of a document) / ``min_share`` words can be that common, so
    what reaches the driver is bounded whatever the size of the corpus. Null texts count as
    documents without words; an empty table has no common words.
    """
    many = texts.count()
    counted = texts.where(F.col(text).isNotNull()).select(F.explode(word_array(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return frozenset(r.word for r in counted.where(F.col("n") >= F.lit(min_share) * F.lit(many)).select("word").collect())


def english_words(chapters: DataFrame, html: str = "html_content") -> frozenset[str]:
    """The common words of English chapters outside italics and tags."""
    plain = F.regexp_replace(F.regexp_replace(html, r"(?is)<(i|em)\b[^>]*>.*?</\1>", " "), "<[^>]*>", " ")
    return common_words(chapters.select(plain.alias("text")))
