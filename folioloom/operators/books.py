"""Whole English books: chapters cleaned and marked, scored and measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import foreign, semantics, spelling, typography
from folioloom.functions import metrics as M
from folioloom.functions import text as X
from folioloom.operators import quality
from folioloom.session import materialise

#: Chapters of a book that its reading ease is taken from, at even steps.
SAMPLED = 5


def cleaned_chapters(chapters: DataFrame, publisher: X.Publisher, english: frozenset[str]) -> DataFrame:
    """(id, book_id, order_num, title, captions, html, words) of chapters (id, book_id, order_num, title, html_content).

    Cleaned, typographic, modernised, semantically marked and language-tagged in one narrow
    pass; one column follows the other, so that no step evaluates the ones before it again.
    Chapters without content are left out.
    """
    held = chapters.where("html_content is not null")
    out = held.select("id", "book_id", "order_num", "title", X.captions(F.col("html_content")).alias("captions"), X.clean_chapter(F.col("html_content"), publisher).alias("html"))
    for step in (typography.typographize, spelling.modernize_spelling, semantics.semanticize, lambda html: foreign.tag_foreign(html, english)):
        out = out.withColumn("html", step(F.col("html")))
    return out.withColumn("words", X.count_words(X.strip_html(F.col("html"))))


def sampled(chapters: DataFrame, most: int = SAMPLED) -> DataFrame:
    """The chapters of each book at even steps: all of at most ``most``, else ``most`` of them from the first on."""
    place = F.row_number().over(Window.partitionBy("book_id").orderBy("order_num", "id")) - 1
    many = F.count("*").over(Window.partitionBy("book_id"))
    numbered = chapters.withColumn("place", place).withColumn("step", F.greatest(F.lit(1), F.floor(many / most)))
    return numbered.where((F.col("place") % F.col("step") == 0) & (F.col("place") / F.col("step") < most)).drop("place", "step")


def reading_ease(chapters: DataFrame) -> DataFrame:
    """(book_id, flesch, cefr, difficulty) from the words and sentences of the sampled chapters (id, book_id, order_num, html)."""
    text = sampled(chapters).select("book_id", X.strip_html(F.col("html")).alias("text"))
    split = text.select("book_id", M.words(F.col("text")).alias("w"), F.size(M.sentences(F.col("text"))).alias("n"))
    sums = split.select("book_id", F.size("w").alias("nw"), "n", M.total_syllables(F.col("w")).alias("s")).groupBy("book_id").agg(F.sum("nw").alias("nw"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    score = sums.select("book_id", M.flesch(F.col("nw"), F.col("n"), F.col("s")).alias("flesch"))
    return score.select("book_id", "flesch", M.cefr(F.col("flesch")).alias("cefr"), M.difficulty(F.col("flesch")).alias("difficulty"))


def english_books(books: DataFrame, chapters: DataFrame, publisher: X.Publisher, english: frozenset[str]) -> DataFrame:
    """(book_id, chapter_count, words, score, tier, passed, issues, flesch, cefr, difficulty, minutes) of books (book_id, has_cover).

    ``chapters`` are those of ``sources.epub.chapters`` or of a table. A book without chapters has
    no reading ease.
    """
    cleaned = materialise(cleaned_chapters(chapters, publisher, english), "cleaned")
    named = cleaned.select("id", "book_id", "order_num", "title", F.col("html").alias("html_content"), F.col("words").cast("int").alias("word_count"))
    scored = quality.english_quality(books, named, publisher)
    sums = cleaned.groupBy(F.col("book_id").alias("s_book")).agg(F.count("*").alias("chapter_count"), F.sum("words").alias("words"))
    ease = reading_ease(cleaned).withColumnRenamed("book_id", "e_book")
    out = scored.join(sums, F.col("book_id") == F.col("s_book"), "left").join(ease, F.col("book_id") == F.col("e_book"), "left")
    words = F.coalesce("words", F.lit(0))
    return out.select("book_id", F.coalesce("chapter_count", F.lit(0)).alias("chapter_count"), words.alias("words"), "score", "tier", "passed", "issues", "flesch", "cefr", "difficulty", M.reading_minutes(words).alias("minutes"))
