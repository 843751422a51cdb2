"""Partitioning of inputs for passes that cost much CPU a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """The frame over all cores, if it has fewer partitions than the cluster has cores.

    A file of one row group is one task; before a costly pass it pays to move its rows.
    Large inputs have more partitions than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def once(df: DataFrame, key: str) -> DataFrame:
    """The rows with each key once; only the rows of keys that recur are shuffled, besides the keys."""
    recurring = df.groupBy(F.col(key).alias("recurring_key")).agg(F.count("*").alias("rows_of_key")).where("rows_of_key > 1").select("recurring_key")
    if recurring.isEmpty():
        return df
    again = F.col(key).eqNullSafe(F.col("recurring_key"))
    return df.join(recurring, again, "left_anti").unionByName(df.join(recurring, again, "left_semi").dropDuplicates([key]))
