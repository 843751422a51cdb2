"""Explicit schemas of the catalogue tables and of source records; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BOOKS = (
    "id string, pg_id int, title string, author string, language string, subjects string, bookshelves string, description string, word_count int, chapter_count int, "
    "status string, quality_score double, flesch_score double, cefr_level string, difficulty_score double, ai_tags string, pipeline_version int, source_type string, "
    "dynasty string, zh_source_id long, created_at string, updated_at string, loaded_at timestamp_ntz"
)
CHAPTERS = "id string, book_id string, order_num int, site string, title string, href string, html_content string, word_count int, created_at string, loaded_at timestamp_ntz"
SOURCE_RECORD = (
    "id int, title string, authors array<struct<name:string,birth_year:int,death_year:int>>, subjects array<string>, bookshelves array<string>, languages array<string>, "
    "formats map<string,string>, download_count long, media_type string"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Source records from JSON files (one record a line, or arrays); malformed ones are dropped."""
    return spark.read.schema(SOURCE_RECORD).option("mode", "DROPMALFORMED").json(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole text files."""
    return spark.read.text(path, wholetext=True).selectExpr("_metadata.file_path as path", "value as text")


def read_images(spark: SparkSession, path: str, pattern: str = "*.{png,jpg,jpeg,webp}") -> DataFrame:
    """(id, path, content) of image files whose name begins with a number."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.selectExpr(r"try_cast(regexp_extract(path, '/(\\d+)[^/]*$', 1) as int) as id", "path", "content").where("id is not null")
