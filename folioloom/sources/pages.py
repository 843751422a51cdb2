"""Saved pages of a paged JSON interface as a Spark data source, one partition a page.

A page is a file ``page-<n>.json`` with an array ``results``. A missing page is empty, as
the interface answers it; a page that can't be read is tried again a few times with growing
waits, then the task fails.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from folioloom.sources.schemas import SOURCE_RECORD

ATTEMPTS, WAIT_SECONDS = 5, 0.2


class _Page(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.first, self.last = int(options.get("first", 1)), options.get("last")

    def partitions(self) -> list[_Page]:
        if self.last is not None:
            return [_Page(n) for n in range(self.first, int(self.last) + 1)]
        found = sorted(int(m[1]) for f in os.listdir(self.folder) if (m := re.fullmatch(r"page-(\d+)\.json", f)))
        return [_Page(n) for n in found if n >= self.first] or [_Page(self.first)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        path = os.path.join(self.folder, f"page-{partition.number}.json")
        for attempt in range(1, ATTEMPTS + 1):
            try:
                with open(path, encoding="utf-8") as page:
                    results = json.load(page).get("results") or []
                break
            except FileNotFoundError:
                return
            except (OSError, ValueError):
                if attempt == ATTEMPTS:
                    raise
                time.sleep(WAIT_SECONDS * attempt)
        for position, record in enumerate(results):
            yield (partition.number, position, json.dumps(record, ensure_ascii=False))


class SavedPages(DataSource):
    """``spark.read.format("saved_pages").option("last", n).load(folder)``: (page, position, record)."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return "page int, position int, record string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_pages(spark: SparkSession, folder: str, first: int = 1, last: int | None = None) -> DataFrame:
    """(page, position, and the columns of a source record) of the saved pages; records that can't be read have nulls."""
    spark.dataSource.register(SavedPages)
    reader = spark.read.format("saved_pages").option("first", first)
    rows = (reader.option("last", last) if last is not None else reader).load(folder)
    return rows.withColumn("r", F.from_json("record", SOURCE_RECORD)).select("page", "position", "r.*")


def lookup(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """The record of each id (one-column frame), the first in page order; ids without one have nulls."""
    place = F.struct("page", "position")
    fields = [c for c in pages.columns if c not in ("page", "position", "id")]
    first = pages.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("r_id")).agg(F.min_by(F.struct(*fields), place).alias("r"))
    wanted = ids.toDF("id").distinct()
    return wanted.join(first, F.col("id") == F.col("r_id"), "left").select("id", *[F.col("r")[c].alias(c) for c in fields])
