"""Core queries that prepare data and that SQL cannot express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioloom.operators import packed_values
from folioloom.session import read_table


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per value packed in books.subjects and books.ai_tags, with its place."""
    return packed_values.unpack_fields(read_table(spark, d, "books"), "id", ["subjects", "ai_tags"]).distinct()


QUERIES = {"p7_found": p7_found}
