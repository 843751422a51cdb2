"""Job feeds as streams: windowed counts, idempotent intake, retry state and status logs.

Each function takes a streaming DataFrame; the batch twins take an ordinary one and give
the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def timed(events: DataFrame, late: str) -> DataFrame:
    """Events with a time zone's time, as watermarks need it, and the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def windowed_counts(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total) by tumbling or sliding window with a watermark."""
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    counted = timed(events, late).groupBy(span.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, n) by session window."""
    counted = timed(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return counted.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def once_within(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """Each key once, as long as its repeats come within the lateness."""
    return timed(events, late).dropDuplicatesWithinWatermark(keys)


_ATTEMPTS = "user_id long, attempts long, failed boolean, last_type string"


def attempts(events: DataFrame, most: int = 3) -> DataFrame:
    """Running (user_id, attempts, failed, last_type): errors count up, other events reset; failed after ``most``."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count = state.get[0] if state.exists else 0
        last = None
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for kind in rows["event_type"]:
            count = count + 1 if kind == "error" else 0
            last = kind
        state.update((count,))
        yield pd.DataFrame([(key[0], count, count >= most, last)], columns=["user_id", "attempts", "failed", "last_type"])

    return events.groupBy("user_id").applyInPandasWithState(step, _ATTEMPTS, "attempts long", "update", GroupStateTimeout.NoTimeout)


def attempts_batch(events: DataFrame, most: int = 3) -> DataFrame:
    """The final rows of ``attempts`` over a whole table."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    numbered = events.select("user_id", "event_type", F.row_number().over(order).alias("n"))
    g = numbered.groupBy("user_id").agg(F.max("n").alias("all"), F.coalesce(F.max(F.when(F.col("event_type") != "error", F.col("n"))), F.lit(0)).alias("reset"), F.max_by("event_type", "n").alias("last_type"))
    count = (F.col("all") - F.col("reset")).cast("long")
    return g.select("user_id", count.alias("attempts"), (count >= most).alias("failed"), "last_type")


def status_log(events: DataFrame) -> DataFrame:
    """(user_id, event_id, before, after) wherever the type differs from the one before."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    moved = events.select("user_id", "event_id", F.lag("event_type").over(order).alias("before"), F.col("event_type").alias("after"))
    return moved.where("not (before <=> after)")


def intake(events: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Runs what has arrived, highest value first within a micro-batch, into Parquet; a batch that repeats is written once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.orderBy(F.col("value").desc(), "event_id").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pull(events: DataFrame, folder: str, checkpoint: str, most: int) -> StreamingQuery:
    """Takes the ``most`` jobs of highest value of each micro-batch and of what waits from before; the rest waits on.

    What is taken stands in ``folder/taken/batch=<n>``, what waits in ``folder/waiting/batch=<n>``.
    Both follow from the batch and the table before it, so a batch that repeats writes the same again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{folder}/waiting/batch={number - 1}"
        waiting = spark.read.schema(batch.schema).parquet(before) if number else batch.limit(0)
        ranked = batch.unionByName(waiting).orderBy(F.col("value").desc_nulls_last(), "event_id")
        taken = ranked.limit(most)
        taken.write.mode("overwrite").parquet(f"{folder}/taken/batch={number}")
        ids = spark.read.parquet(f"{folder}/taken/batch={number}").select(F.col("event_id").alias("t_id"))
        batch.unionByName(waiting).join(ids, F.col("event_id") == F.col("t_id"), "left_anti").write.mode("overwrite").parquet(f"{folder}/waiting/batch={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
