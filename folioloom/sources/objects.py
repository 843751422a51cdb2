"""A folder as an object store: texts by key, deletion by key and prefix, and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def put_texts(df: DataFrame, folder: str, parent: str = "book_id") -> None:
    """Writes rows (parent, id, ...) partitioned by parent; the parents written before are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(parent).parquet(folder)


def get_texts(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a store."""
    return spark.read.parquet(folder)


def delete_prefix(spark: SparkSession, folder: str, prefix: str) -> int:
    """Removes everything under the folder whose name begins with the prefix; the number of entries removed.

    A prefix with ``..`` or an absolute one is refused.
    """
    if ".." in prefix.split("/") or prefix.startswith("/"):
        raise ValueError(f"prefix {prefix!r} leaves the folder")
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}*")
    system = pattern.getFileSystem(context._jsc.hadoopConfiguration())
    found = [f.getPath() for f in (system.globStatus(pattern) or [])]
    for path in found:
        system.delete(path, True)
    return len(found)


def write_report(df: DataFrame, folder: str) -> None:
    """A report as JSON, one indented object a row, in one text file (reports have a few rows)."""
    df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(folder)
