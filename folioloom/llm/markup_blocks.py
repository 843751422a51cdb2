"""Markup residue removed from columns of texts; see ``markup`` for the rules.

Both operators are narrow: one pass over the texts, no shuffle (repeated rows repeat).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import markup


def _texts(texts: DataFrame) -> DataFrame:
    return texts.select(F.col("part").cast("string").alias("part"), F.col("id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))


def blocks(texts: DataFrame) -> DataFrame:
    """(part, id, line_no, block_kind, block_text) of every structure block in the body of a text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for part, key, text in zip(batch["part"], batch["id"], batch["text"]):
                rows += [(part, key, b.line + 1, b.kind, b.text) for b in markup.structure(text)[0]]
            yield pd.DataFrame(rows, columns=["part", "id", "line_no", "block_kind", "block_text"])

    chosen = _texts(texts).where(F.col("text").isNotNull() & (F.length("text") > 0))
    return chosen.mapInPandas(run, "part string, id string, line_no int, block_kind string, block_text string")


def clean(texts: DataFrame) -> DataFrame:
    """(part, id, clean_text): null texts stay null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"part": batch["part"], "id": batch["id"], "clean_text": [markup.clean_text(t) for t in batch["text"]]})

    return _texts(texts).mapInPandas(run, "part string, id string, clean_text string")
