"""Listing pages as rows: links with the author carried down, and links with the better format per book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.operators import catalog as C

_EVENT = r'(?i)<font\s+color="CC0000">([^<]+)</font>|<a[^>]+href="[^"]*[?&]M=book&(?:amp;)?P=(\d+)"[^>]*>([^<]+)</a>'


def author_listing(pages: DataFrame) -> DataFrame:
    """(page, book_id, title, author) of pages (page, html): every book link with the last author named before it."""
    html = F.col("html")
    events = F.arrays_zip(*[F.regexp_extract_all(html, F.lit(_EVENT), F.lit(k)).alias(n) for k, n in ((1, "name"), (2, "book_id"), (3, "title"))])
    rows = pages.select("page", F.posexplode(events).alias("position", "e")).select("page", "position", "e.*")
    rows = rows.withColumn("named", F.when((F.trim("name") != "") & (F.length(F.trim("name")) < 20), F.trim("name")))
    filled = C.fill_down(rows, "page", "position", "named", "author")
    title = F.trim(F.translate("title", "【】《》[]", ""))
    return filled.where("book_id != ''").select("page", "book_id", title.alias("title"), F.coalesce("author", F.lit("未知")).alias("author")).where("title != ''")


def book_id_of(url: Column) -> Column:
    """Last part of a URL's path without extension, unsafe characters as ``-``."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z]+://[^/]+", ""), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?i)\.(epub|txt)$", ""), r"[^0-9A-Za-z\x{4e00}-\x{9fff}._-]+", "-")


def resolve(base: str, href: Column) -> Column:
    """Absolute form of a link."""
    return F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(href, "^/+", "")))


def download_listing(pages: DataFrame, base: str) -> DataFrame:
    """(page, book_id, title, url, format) of pages (page, html): one link per book, EPUB before text, then first."""
    html = F.col("html")
    link = r'(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(link), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(link), F.lit(2)).alias("label"))
    rows = pages.select("page", F.posexplode(pairs).alias("position", "e")).select("page", "position", F.trim("e.href").alias("href"), F.trim(F.regexp_replace("e.label", "<[^>]+>", "")).alias("label"))
    hint = F.lower(F.concat("href", F.lit(" "), F.when(F.contains("href", F.lit("download")), F.col("label")).otherwise(F.lit(""))))
    kind = F.when(F.lower("href").endswith(".epub"), "epub").when(F.lower("href").endswith(".txt"), "txt").when(F.contains("href", F.lit("download")) & F.contains(hint, F.lit("epub")), "epub").when(F.contains("href", F.lit("download")) & F.contains(hint, F.lit("txt")), "txt")
    named = rows.withColumn("format", kind).where("format is not null").withColumn("book_id", book_id_of(F.col("href")))
    rank = F.row_number().over(Window.partitionBy("book_id").orderBy((F.col("format") != "epub").cast("int"), "page", "position"))
    title = F.trim(F.regexp_replace("label", r"(?i)\s*(epub|txt)\s*$", ""))
    return named.withColumn("r", rank).where("r = 1").select("page", "book_id", title.alias("title"), resolve(base, F.col("href")).alias("url"), "format")
