"""Graph building on a stream: the second pass is stateless once tables are learned; interactions are deduplicated within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_canonical(stream: DataFrame, mapping: DataFrame) -> DataFrame:
    """Triples of a stream with values replaced by what was learned: a stream joined with a static table (relation, value, target)."""
    return stream.join(mapping, ["relation", "value"], "left").withColumn("value", F.coalesce("target", "value")).drop("target")


def stream_counts(stream: DataFrame) -> DataFrame:
    """Running counts of the variants of a stream, for update or complete mode."""
    return stream.filter("relation IS NOT NULL AND value IS NOT NULL").groupBy("relation", "value").agg(F.count(F.lit(1)).alias("n"))


def stream_interactions(stream: DataFrame, time: str = "ingested_at", delay: str = "1 day") -> DataFrame:
    """Each (user, item) pair once within the watermark, late repeats dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["user", "item"])


def windowed_activity(stream: DataFrame, time: str = "ingested_at", delay: str = "1 day", width: str = "7 days") -> DataFrame:
    """window, category, n_rows, rating_sum by event time; late rows within the watermark count."""
    return (
        stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), "category").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("rating").alias("rating_sum"))
        .select(F.col("w.start").alias("window_start"), "category", "n_rows", "rating_sum")
    )
