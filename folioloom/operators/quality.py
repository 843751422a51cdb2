"""Checks over the chapters of a book and the scores that follow from them.

One narrow pass over the texts keeps numbers and hashes; one aggregation by book and one by
repeated item follow, then one row-wise expression per score; no group is collected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import chinese
from folioloom.functions import metrics as M
from folioloom.functions import text as X
from folioloom.functions.text import round_half_up
from folioloom.operators import catalog as C
from folioloom.session import materialise


# Thresholds and losses of the checks, in the order of the checks.
FEW_CHAPTERS, NO_CHAPTERS_LOSS, FEW_CHAPTERS_LOSS = 2, 50, 15
COVER_LOSS, BROKEN_LOSS, EMPTY_LOSS = 10, 15, 5
TITLES_LOSS, TRUNCATED_LOSS, GAPS_LOSS = 10, 10, 5
RESIDUE_CAP, RESIDUE_LOSS = 30, 40
PARAGRAPH_LOSS, PARAGRAPHS_ALLOWED, PARAGRAPHS_MOST = 3, 3, 15
APPROVED, REVIEW = 80, 60


def _content_key(text: Column) -> Column:
    """Hash of a text (``strip_html``, so its blanks are single spaces) without blanks and case; null if it is short."""
    return X.bound(F.replace(F.lower(text), F.lit(" "), F.lit("")), lambda bare: F.when(F.length(bare) >= 100, F.sha1(bare)))


def chapter_measures(chapters: DataFrame, publisher: X.Publisher) -> DataFrame:
    """Chapters (id, book_id, order_num, title, html_content, word_count) with the measures that the checks need.

    One narrow pass over the texts, kept as a table: the checks read numbers and hashes only.
    """
    html, title = F.coalesce("html_content", F.lit("")), F.coalesce("title", F.lit(""))
    paragraphs = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<p[^>]*>.*?</p>"), F.lit(0)), lambda p: F.lower(X.trim_ws(F.regexp_replace(p, "<[^>]+>", ""))))
    # text and words are columns of their own, so each is worked out once
    stripped = chapters.withColumn("stripped", X.strip_html(html)).withColumn("long", X.long_words(F.col("stripped")))
    measured = stripped.select(
        "id",
        "book_id",
        "order_num",
        F.coalesce("word_count", F.lit(0)).alias("words"),
        F.lower(X.trim_ws(title)).alias("title_key"),
        M.chapter_number(title).alias("number"),
        X.has_mojibake(html).alias("broken"),
        X.has_residue(html, publisher).alias("residue"),
        _content_key(F.col("stripped")).alias("content_key"),
        F.size("long").alias("long_words"),
        F.size(X.foreign_words(F.col("long"))).alias("foreign_words"),
        F.transform(F.filter(paragraphs, lambda p: F.length(p) > 50), lambda p: F.xxhash64(p)).alias("paragraph_keys"),
    )
    return materialise(measured, "measures")


def _repeated(rows: DataFrame) -> DataFrame:
    """(book, dup_titles, dup_chapters, dup_paragraphs) from (book_id, kind, item): items that a book holds more than once."""
    counted = rows.groupBy("book_id", "kind", "item").agg(F.count("*").alias("n")).where("n > 1")
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value).otherwise(0))
    return counted.groupBy(F.col("book_id").alias("r_book")).agg(
        of("title", F.lit(1)).alias("dup_titles"), of("content", F.col("n")).alias("dup_chapters"), of("paragraph", F.lit(1)).alias("dup_paragraphs")
    )


def _items(measures: DataFrame, kind: str, item: Column) -> DataFrame:
    return measures.select("book_id", F.lit(kind).alias("kind"), item.alias("item")).where(F.col("item").isNotNull() & (F.col("item") != ""))


def book_checks(chapters: DataFrame, publisher: X.Publisher) -> DataFrame:
    """One row per book with the results of all checks."""
    m = chapter_measures(chapters, publisher)
    place = F.row_number().over(Window.partitionBy("book_id").orderBy("order_num", "id"))
    filled = F.when(F.col("words") > 0, F.col("words"))
    head = lambda c: F.sum(F.when(F.col("place") <= 3, F.col(c)))
    base = m.withColumn("place", place).groupBy("book_id").agg(
        F.count("*").alias("n_chapters"),
        F.sum("words").alias("n_words"),
        F.count_if(F.col("words") < 50).alias("n_empty"),
        F.max(F.col("broken").cast("int")).alias("broken"),
        F.count_if("residue").alias("n_residue"),
        F.max_by("words", "place").alias("last_words"),
        F.min_by("words", "place").alias("first_words"),
        F.min_by("title_key", "place").alias("first_title"),
        F.avg("words").alias("mean_words"),
        F.coalesce(F.try_divide(head("foreign_words"), head("long_words")), F.lit(0.0)).alias("foreign_ratio"),
        (F.stddev_pop(filled) / F.avg(filled)).alias("cv"),
        F.count(filled).alias("n_filled"),
    )
    items = _items(m, "title", F.col("title_key")).unionByName(_items(m, "content", F.col("content_key")))
    items = items.unionByName(_items(m, "paragraph", F.explode(F.transform("paragraph_keys", lambda k: k.cast("string")))))
    gaps = C.sequence_gaps(m, "book_id", "number").groupBy(F.col("book_id").alias("g_book")).agg(F.count("*").alias("gaps"))
    out = base.join(_repeated(items), F.col("book_id") == F.col("r_book"), "left").join(gaps, F.col("book_id") == F.col("g_book"), "left")
    return out.drop("r_book", "g_book").na.fill(0, ["dup_titles", "gaps", "dup_chapters", "dup_paragraphs"])


def _books_with(books: DataFrame, checks: DataFrame) -> DataFrame:
    """Books (book_id, has_cover) with their checks; a book without chapters has zeros."""
    joined = books.select(F.col("book_id").alias("b_book"), "has_cover").join(checks, F.col("b_book") == F.col("book_id"), "left").drop("book_id").withColumnRenamed("b_book", "book_id")
    numbers = [f.name for f in checks.schema if f.name != "book_id" and f.dataType.simpleString() in ("bigint", "int", "double")]
    return joined.na.fill(0, numbers)


def _scored(checked: DataFrame, score: Column, issues: list[tuple[str, Column]], downgrade: Column) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, when in issues]))
    out = checked.select("book_id", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int").alias("score"), found.alias("issues"), F.coalesce(downgrade, F.lit(False)).alias("down"))
    return out.select("book_id", "score", tier(F.col("score"), F.col("down")).alias("tier"), (F.col("score") >= REVIEW).alias("passed"), "issues")


def english_quality(books: DataFrame, chapters: DataFrame, publisher: X.Publisher) -> DataFrame:
    """(book_id, score, tier, passed, issues) of books (book_id, has_cover) by the checks over their chapters.

    The total loss for an impossible size comes before later losses, the cap for residue
    where its check stands, the total loss for equal chapters last. A preface that dominates
    takes the best tier away.
    """
    return _scored(_books_with(books, book_checks(chapters, publisher)), english_score(), english_issues(), preface_dominates())


def english_score(c: type = F.col) -> Column:
    """The score before it is held within 0 to 100."""
    score = F.lit(100) - F.when(c("n_chapters") == 0, NO_CHAPTERS_LOSS).when(c("n_chapters") < FEW_CHAPTERS, FEW_CHAPTERS_LOSS).otherwise(0)
    score = score - F.when(c("n_words") < 1000, 30).when(c("n_words") < 5000, 10).otherwise(0)
    score = F.when(c("n_words") > 1_500_000, F.lit(0)).otherwise(score - F.when(c("n_words") > 800_000, 10).otherwise(0))
    score = score - c("n_empty") * EMPTY_LOSS - F.when(~c("has_cover"), COVER_LOSS).otherwise(0)
    score = score - F.when(c("broken") > 0, BROKEN_LOSS).otherwise(0) - F.when(c("dup_titles") > 0, TITLES_LOSS).otherwise(0)
    score = score - F.when(_truncated(c), TRUNCATED_LOSS).otherwise(0) - F.when(c("gaps") > 0, GAPS_LOSS).otherwise(0)
    score = _residue_loss(score, c)
    score = score - F.when(c("dup_paragraphs") > PARAGRAPHS_ALLOWED, F.least(F.lit(PARAGRAPHS_MOST), c("dup_paragraphs") * PARAGRAPH_LOSS)).otherwise(0)
    score = score - F.when(c("foreign_ratio") > 0.3, 20).when(c("foreign_ratio") > 0.15, 10).otherwise(0) - _variation_loss(c)
    return F.when(c("dup_chapters") > 0, F.lit(0)).otherwise(score)


def english_issues(c: type = F.col) -> list[tuple[str, Column]]:
    """(name, whether it holds) of the issues, in the order of the checks."""
    return [
        ("no_chapters", c("n_chapters") == 0),
        ("few_chapters", (c("n_chapters") > 0) & (c("n_chapters") < FEW_CHAPTERS)),
        ("very_few_words", c("n_words") < 1000),
        ("few_words", (c("n_words") >= 1000) & (c("n_words") < 5000)),
        ("impossible_size", c("n_words") > 1_500_000),
        ("very_long", (c("n_words") > 800_000) & (c("n_words") <= 1_500_000)),
        ("empty_chapters", c("n_empty") > 0),
        ("no_cover", ~c("has_cover")),
        ("encoding", c("broken") > 0),
        ("repeated_titles", c("dup_titles") > 0),
        ("truncated_end", _truncated(c)),
        ("sequence_gaps", c("gaps") > 0),
        ("residue", c("n_residue") > 0),
        ("repeated_paragraphs", c("dup_paragraphs") > PARAGRAPHS_ALLOWED),
        ("foreign", c("foreign_ratio") > 0.15),
        ("length_variation", _variation_loss(c) > 0),
        ("equal_chapters", c("dup_chapters") > 0),
        ("preface_dominates", preface_dominates(c)),
    ]


def _truncated(c: type) -> Column:
    return (c("n_chapters") >= 3) & (c("last_words") < c("mean_words") * 0.3) & (c("last_words") < 200)


def _residue_loss(score: Column, c: type) -> Column:
    ratio = F.coalesce(F.try_divide(c("n_residue"), c("n_chapters")), F.lit(0.0))
    return F.when(ratio >= 0.5, F.least(score, F.lit(RESIDUE_CAP))).otherwise(score - round_half_up(ratio * RESIDUE_LOSS))


def _variation_loss(c: type) -> Column:
    return F.when(c("n_filled") >= 4, F.when(c("cv") > 2.0, 10).when(c("cv") > 1.5, 5).otherwise(0)).otherwise(0)


#: Titles of chapters that stand before a book's own text.
PREFACE = r"\b(introduction|preface|translator|foreword|prologue)\b"


def preface_dominates(c: type = F.col) -> Column:
    """Whether the first of several chapters is an introduction of 30 % of the words or more."""
    return (c("n_chapters") >= 2) & (c("n_words") > 0) & (c("first_words") >= 0.3 * c("n_words")) & c("first_title").rlike(PREFACE)


def tier(score: Column, downgrade: Column | None = None) -> Column:
    """Quality tier of a score; a downgrade takes the best tier away."""
    best = F.when(downgrade, "needs_review").otherwise("auto_approved") if downgrade is not None else F.lit("auto_approved")
    return F.when(score >= APPROVED, best).when(score >= REVIEW, "needs_review").otherwise("rejected")


def first_dominates(chapters: DataFrame) -> DataFrame:
    """(book_id) of books whose first chapter is an introduction of 30 % of the words or more."""
    place = F.struct("order_num", "id")
    words = F.coalesce("word_count", F.lit(0))
    g = chapters.groupBy("book_id").agg(F.count("*").alias("n"), F.sum(words).alias("total"), F.min_by(words, place).alias("first"), F.min_by(F.lower("title"), place).alias("title"))
    return g.where((F.col("n") >= 2) & (F.col("total") > 0) & (F.col("first") >= 0.3 * F.col("total")) & F.col("title").rlike(PREFACE)).select("book_id")


_NO_WORD = re.compile(r"[^a-z0-9\s]+", re.ASCII)
_BLANKS = re.compile(r"\s+", re.ASCII)
_FIDELITY = "our_words int, their_words int, alignment string, miss_rate double"


def compare_texts(ours: str, theirs: str, window: tuple[int, int] = (200, 400)) -> tuple[int, int, str, float]:
    """(words of ours, of theirs, alignment, miss rate) of two texts: bags of words, and whether a window of ours stands in theirs."""
    a, b = (_BLANKS.sub(" ", _NO_WORD.sub(" ", t.lower())).strip(" ") for t in (ours, theirs))
    left, right = a.split(" ") if a else [], b.split(" ") if b else []
    counts = Counter(left)
    counts.subtract(right)
    both = len(left) + len(right)
    missed = sum(map(abs, counts.values())) / both if both else 1.0
    low, high = window
    aligned = "NA" if min(len(a), len(b)) <= high + low else "OK" if a[low:high] in b else "MISS"
    return len(left), len(right), aligned, missed


def fidelity(pairs: DataFrame) -> DataFrame:
    """Audit of texts (key, ours, theirs): word ratio, sizes, alignment, multiset miss rate and verdict.

    Spark has no function for multisets; both texts stand in one row, so they are compared
    where they are (Arrow batches), without exploding or shuffling a word. Null texts are empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [compare_texts(a or "", b or "") for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            columns = list(zip(*found)) if found else [()] * 4
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]], ["key", "our_words", "their_words", "alignment", "miss_rate"])

    kind = pairs.schema["key"].dataType.simpleString()
    out = pairs.select("key", "ours", "theirs").mapInArrow(run, f"key {kind}, {_FIDELITY}")
    ratio = F.col("our_words") / F.greatest(F.col("their_words"), F.lit(1))
    ok = ratio.between(0.95, 1.05) & (F.col("alignment") != "MISS") & (F.col("miss_rate") < 0.05)
    warn = ratio.between(0.9, 1.1) & (F.col("miss_rate") < 0.1)
    return out.withColumn("word_ratio", ratio).withColumn("verdict", F.when(ok, "OK").when(warn, "WARN").otherwise("SUSPECT"))


def vocabulary_levels(texts: DataFrame, vocabulary: DataFrame, longest: int = 4) -> DataFrame:
    """(key, level, n): tokens of Chinese texts (key, text) by vocabulary level; null for unknown.

    ``vocabulary`` (word, level) is a parameter. Tokens come from forward maximum matching:
    at each place the longest listed word, else one character. The words reach the workers
    with the task and must fit in memory (at most ``MAX_VOCABULARY`` rows, checked).
    """
    rows = vocabulary.groupBy("word").agg(F.min("level").alias("level")).limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary has more than {MAX_VOCABULARY} words")
    level = {r.word: int(r.level) for r in rows}
    longest = max([longest, *map(len, level)]) if level else longest

    def run(batches):
        for batch in batches:
            out = []
            for key, text in zip(batch["key"], batch["text"]):
                counts: dict = {}
                at = 0
                while at < len(text):
                    if not "㐀" <= text[at] <= "鿿":
                        at += 1
                        continue
                    size = next((n for n in range(min(longest, len(text) - at), 1, -1) if text[at : at + n] in level), 1)
                    found = level.get(text[at : at + size])
                    counts[found] = counts.get(found, 0) + 1
                    at += size
                out += [(key, lv, n) for lv, n in counts.items()]
            yield pd.DataFrame(out, columns=["key", "level", "n"]).astype({"level": "Int32"})

    return texts.select("key", "text").where("text is not null").mapInPandas(run, f"key {texts.schema['key'].dataType.simpleString()}, level int, n long")


MAX_VOCABULARY = 50_000


def chinese_score(c: type = F.col) -> Column:
    """The score of a Chinese book before it is held within 0 to 100: sizes in characters, equal chapters before variation and residue."""
    score = F.lit(100) - F.when(c("n_chapters") == 0, NO_CHAPTERS_LOSS).when(c("n_chapters") < FEW_CHAPTERS, FEW_CHAPTERS_LOSS).otherwise(0)
    score = F.when(c("n_words") > 2_000_000, F.lit(0)).otherwise(score - F.when(c("n_words") < 500, 30).when(c("n_words") < 2000, 10).otherwise(0))
    score = score - c("n_empty") * EMPTY_LOSS - F.when(~c("has_cover"), COVER_LOSS).otherwise(0)
    score = score - F.when((c("n_signs") > 0) & (c("cjk_ratio") < 0.3), 20).otherwise(0) - F.when(c("broken") > 0, BROKEN_LOSS).otherwise(0)
    score = F.when(c("dup_chapters") > 0, F.lit(0)).otherwise(score)
    return _residue_loss(score - _variation_loss(c), c)


def chinese_issues(c: type = F.col) -> list[tuple[str, Column]]:
    """(name, whether it holds) of the issues, in the order of the checks."""
    return [
        ("no_chapters", c("n_chapters") == 0),
        ("few_chapters", (c("n_chapters") > 0) & (c("n_chapters") < FEW_CHAPTERS)),
        ("impossible_size", c("n_words") > 2_000_000),
        ("very_few_characters", c("n_words") < 500),
        ("few_characters", (c("n_words") >= 500) & (c("n_words") < 2000)),
        ("empty_chapters", c("n_empty") > 0),
        ("no_cover", ~c("has_cover")),
        ("low_cjk_ratio", (c("n_signs") > 0) & (c("cjk_ratio") < 0.3)),
        ("encoding", c("broken") > 0),
        ("equal_chapters", c("dup_chapters") > 0),
        ("length_variation", _variation_loss(c) > 0),
        ("residue", c("n_residue") > 0),
    ]


def chinese_quality(books: DataFrame, chapters: DataFrame, publisher: X.Publisher) -> DataFrame:
    """(book_id, score, tier, passed, issues) of Chinese books (book_id, has_cover) by the checks over their chapters."""
    return _scored(_books_with(books, chinese_checks(chapters, publisher)), chinese_score(), chinese_issues(), F.lit(False))


def chinese_checks(chapters: DataFrame, publisher: X.Publisher) -> DataFrame:
    """One row per Chinese book with the checks that ``chinese_score`` reads; ``n_words`` counts ideographs."""
    html, text = F.coalesce("html_content", F.lit("")), F.col("stripped")
    m = chapters.withColumn("stripped", X.strip_html(html)).select(
        "id", "book_id", "order_num", X.count_cjk(text).alias("size"), X.count_nonspace(text).alias("signs"), X.has_mojibake(html).alias("broken"),
        X.has_residue(html, publisher).alias("residue"), _content_key(text).alias("content_key"),
    )
    m = materialise(m, "measures_zh")
    place = F.row_number().over(Window.partitionBy("book_id").orderBy("order_num", "id"))
    filled = F.when(F.col("size") > 0, F.col("size"))
    head = lambda col: F.sum(F.when(F.col("place") <= 3, F.col(col)))
    base = m.withColumn("place", place).groupBy("book_id").agg(
        F.count("*").alias("n_chapters"),
        F.sum("size").alias("n_words"),
        F.count_if(F.col("size") < 20).alias("n_empty"),
        F.max(F.col("broken").cast("int")).alias("broken"),
        F.count_if("residue").alias("n_residue"),
        head("signs").alias("n_signs"),
        F.coalesce(F.try_divide(head("size"), head("signs")), F.lit(1.0)).alias("cjk_ratio"),
        (F.stddev_pop(filled) / F.avg(filled)).alias("cv"),
        F.count(filled).alias("n_filled"),
    )
    out = base.join(_repeated(_items(m, "content", F.col("content_key"))), F.col("book_id") == F.col("r_book"), "left")
    return out.drop("r_book", "dup_titles", "dup_paragraphs").na.fill(0, ["dup_chapters"])


_HEADING = re.compile(r"<h[1-6][^>]*>(.*?)</h[1-6]>", re.S | re.I)
_PARAGRAPH = re.compile(r"<p[^>]*>(.*?)</p>", re.S | re.I)


def detected_chapters(texts: DataFrame) -> DataFrame:
    """(key, position, title, pattern) of Chinese chapter titles in HTML (key, html): headings, else paragraphs of 1 to 50 characters.

    ``position`` is the offset of the element in the text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, html in zip(batch["key"], batch["html"]):
                rows += [(key, True, m.start(), m[1]) for m in _HEADING.finditer(html)]
                rows += [(key, False, m.start(), m[1]) for m in _PARAGRAPH.finditer(html)]
            yield pd.DataFrame(rows, columns=["key", "is_heading", "position", "raw"])

    kind = texts.schema["key"].dataType.simpleString()
    elements = texts.where("html is not null").select("key", "html").mapInPandas(run, f"key {kind}, is_heading boolean, position int, raw string")
    title = X.strip_tags_decode(F.col("raw"))
    named = elements.select("key", "is_heading", "position", title.alias("title")).where(F.col("is_heading") | F.length("title").between(1, 50))
    found = materialise(named.withColumn("pattern", M.zh_title_pattern(F.col("title"))).where("pattern is not null"), "titles")
    with_heading = found.where("is_heading").select(F.col("key").alias("h_key")).distinct()
    short = found.where("not is_heading").join(with_heading, F.col("key") == F.col("h_key"), "left_anti")
    return found.where("is_heading").unionByName(short).select("key", "position", "title", "pattern")


def clean_chinese(texts: DataFrame, split_over: int = 10_000, least: int = 50) -> DataFrame:
    """(key, order_num, title, html, characters, script, needs_punctuation) of Chinese books of one text (key, title, html).

    Scripts, styles and links go; a text whose first 2,000 characters are traditional becomes
    simplified; a text of more than ``split_over`` characters is cut at the chapter titles
    found in it, pieces of fewer than ``least`` characters go, and if one piece or none is
    left the text stays whole. Null texts give no rows.
    """
    plain = X.strip_html(F.col("html"))
    script = F.when(chinese.is_traditional(F.left(plain, F.lit(2000))), "traditional").otherwise("simplified")
    html = X.drop_active_tags(F.col("html"))
    base = texts.where("html is not null").select("key", F.col("title").alias("book_title"), html.alias("html"), script.alias("script"))
    base = base.withColumn("html", F.when(F.col("script") == "traditional", chinese.to_simplified(F.col("html"))).otherwise(F.col("html")))
    base = materialise(base.withColumn("characters", X.count_nonspace(X.strip_html(F.col("html")))), "zh_texts")
    large = base.where(F.col("characters") > split_over).select("key", "html")
    marks = detected_chapters(large).withColumnRenamed("key", "d_key")
    spans = marks.withColumn("until", F.lead("position").over(Window.partitionBy("d_key").orderBy("position")))
    cut = base.join(spans, F.col("key") == F.col("d_key"))
    piece = F.substring("html", F.col("position") + 1, F.coalesce(F.col("until"), F.length("html")) - F.col("position"))
    pieces = cut.select("key", "script", "position", "title", piece.alias("html")).withColumn("characters", X.count_nonspace(X.strip_html(F.col("html")))).where(F.col("characters") >= least)
    many = F.count("*").over(Window.partitionBy("key"))
    pieces = materialise(C.renumber(pieces.withColumn("many", many).where("many > 1"), "key", F.col("position"), name="order_num"), "zh_pieces")
    whole = base.join(pieces.select(F.col("key").alias("p_key")).distinct(), F.col("key") == F.col("p_key"), "left_anti")
    out = whole.select("key", F.lit(1).alias("order_num"), F.col("book_title").alias("title"), "html", "characters", "script").unionByName(pieces.select("key", "order_num", "title", "html", "characters", "script"))
    return out.withColumn("needs_punctuation", X.needs_punctuation(X.strip_html(F.col("html"))))


def level_shares(levels: DataFrame) -> DataFrame:
    """(key, tokens, level, unknown, distribution) from (key, level, n): mean level of known words, 6 without any, and counts by level."""
    known = F.sum(F.when(F.col("level").isNotNull(), F.col("n")))
    weighted = F.sum(F.col("level") * F.col("n"))
    name = F.coalesce(F.col("level").cast("string"), F.lit("unknown"))
    return levels.groupBy("key").agg(
        F.sum("n").alias("tokens"),
        F.coalesce(F.try_divide(weighted, known), F.lit(6.0)).alias("level"),
        F.coalesce(F.sum(F.when(F.col("level").isNull(), F.col("n"))), F.lit(0)).alias("unknown"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(name.alias("level"), "n")))).alias("distribution"),
    )


def process_chinese(texts: DataFrame, vocabulary: DataFrame, publisher: X.Publisher, least: int = 20) -> DataFrame:
    """(book_id, chapter_count, characters, score, tier, issues, level, difficulty, minutes) of Chinese books of one text (key, title, html, has_cover).

    Chapters come from ``clean_chinese``, those of fewer than ``least`` ideographs go; the
    difficulty is that of the first 5,000 characters of the first three.
    """
    cleaned = clean_chinese(texts).withColumn("size", X.count_cjk(X.strip_html(F.col("html")))).where(F.col("size") >= least)
    chapters = materialise(cleaned.select(F.concat_ws("/", "key", "order_num").alias("id"), F.col("key").alias("book_id"), "order_num", "title", F.col("html").alias("html_content"), F.col("size").cast("int").alias("word_count")), "zh_chapters")
    scored = chinese_quality(texts.select(F.col("key").alias("book_id"), "has_cover").distinct(), chapters, publisher)
    head = chapters.where("order_num <= 3").groupBy("book_id").agg(F.left(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("order_num", "html_content"))), lambda x: X.strip_html(x["html_content"])), " "), F.lit(5000)).alias("text"))
    shares = level_shares(vocabulary_levels(head.select(F.col("book_id").alias("key"), "text"), vocabulary)).withColumnRenamed("key", "l_book")
    sentences = F.greatest(F.size(M.zh_sentences(F.col("text"))), F.lit(1))
    lengths = head.select(F.col("book_id").alias("s_book"), (X.count_nonspace(F.col("text")) / sentences).alias("sentence_length"))
    sums = chapters.groupBy(F.col("book_id").alias("c_book")).agg(F.count("*").alias("chapter_count"), F.sum("word_count").alias("characters"))
    out = scored.join(sums, F.col("book_id") == F.col("c_book"), "left").join(shares, F.col("book_id") == F.col("l_book"), "left").join(lengths, F.col("book_id") == F.col("s_book"), "left")
    level = F.greatest(F.lit(1), F.least(F.lit(6), round_half_up(F.coalesce(F.col("level"), F.lit(6.0))))).cast("int")
    unknown = F.coalesce(F.try_divide("unknown", "tokens"), F.lit(0.0))
    return out.select(
        "book_id", F.coalesce("chapter_count", F.lit(0)).alias("chapter_count"), F.coalesce("characters", F.lit(0)).alias("characters"), "score", "tier", "issues",
        F.concat(F.lit("HSK"), level.cast("string")).alias("level"), M.zh_difficulty(F.coalesce(F.col("level"), F.lit(6.0)), unknown, F.coalesce("sentence_length", F.lit(0.0))).alias("difficulty"),
        round_half_up(F.coalesce("characters", F.lit(0)) / 500).cast("long").alias("minutes"),
    )


def calibration(pairs: DataFrame, tolerance: float = 0.15, least: int = 80) -> DataFrame:
    """(key, difference, passed): relative word difference against ground truth (key, words, truth, score)."""
    difference = (F.col("words") - F.col("truth")) / F.when(F.col("truth") == 0, F.lit(1)).otherwise(F.col("truth"))
    rounded = round_half_up(difference * 10_000) / 10_000
    return pairs.select("key", rounded.alias("difference"), ((F.abs(difference) <= tolerance) & (F.col("score") >= least)).alias("passed"))
