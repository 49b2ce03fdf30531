"""References to records that do not exist: linear merge of references with the validity intervals of their parents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.common import hot_keys

MISSING, LATE, DELETED, UNDATED = "missing", "late", "deleted", "undated"


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """References without a valid parent, with the reason.

    refs: source_table STRING, row_id BIGINT, key STRING, at TIMESTAMP (other columns are ignored).
    parents: key STRING, valid_from TIMESTAMP, valid_to TIMESTAMP (null: still valid).
    Returns source_table, row_id, key, at, status, one row per orphan reference row (repeated rows stay repeated).

    Both sides are co-partitioned by key and sorted by time, a parent before a reference of the same moment, and
    merged in one pass: the largest end among the intervals begun so far says whether a reference is covered.
    A key that holds a large share of the references is split into salted parts, and only its few parent
    intervals are repeated for each part.

    status: ``missing`` (the key has no parent at any time), ``late`` (its first parent begins later),
    ``deleted`` (all intervals begun have ended), ``undated`` (the reference has no time, its key has parents).
    A reference with a null key is no reference and never comes out. Parents with a null key are ignored; those
    with a null begin make the key known but cover nothing. An interval that ends when or before it begins covers
    nothing. Empty tables: no parents make every reference missing; no references give no rows.
    """
    refs = refs.select("source_table", "row_id", "key", "at").filter(F.col("key").isNotNull())
    parents = parents.select("key", "valid_from", "valid_to").filter(F.col("key").isNotNull())
    hot = F.broadcast(hot_keys(refs, "key"))  # at most HOT_SHARE rows
    never = F.lit("9999-12-31 23:59:59").cast("timestamp")
    salted = refs.join(hot, "key", "left").select(
        "key",
        F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("source_table", "row_id"), F.col("salts"))).cast("int").alias("salt"),
        F.lit(2).alias("kind"), "at", F.lit(None).cast("timestamp").alias("ends"), "source_table", "row_id",
    )
    begun = F.struct(F.lit(1).alias("kind"), F.col("valid_from").alias("at"), F.coalesce("valid_to", never).alias("ends"))
    known = F.struct(F.lit(0).alias("kind"), F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("timestamp").alias("ends"))
    spread = (
        parents.join(hot, "key", "left")
        .select("key", "valid_from", "valid_to", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)).alias("salt"))
        .select("key", "salt", F.explode(F.array(known, begun)).alias("p"))
    ).select("key", "salt", "p.kind", "p.at", "p.ends", F.lit(None).cast("string").alias("source_table"), F.lit(None).cast("bigint").alias("row_id"))
    spread = spread.filter((F.col("kind") == 0) | F.col("at").isNotNull())
    w = Window.partitionBy("key", "salt").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = salted.unionByName(spread).select(
        "*", F.max(F.when(F.col("kind") < 2, True)).over(w).alias("known"), F.max("ends").over(w).alias("until")
    )
    return (
        merged.filter("kind = 2 AND NOT coalesce(until > at, false)")
        .withColumn(
            "status",
            F.when(F.col("known").isNull(), MISSING).when(F.col("at").isNull(), UNDATED).when(F.col("until").isNull(), LATE).otherwise(DELETED),
        )
        .select("source_table", "row_id", "key", "at", "status")
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts per source_table, month (yyyy-MM of the reference's time, null where it has none) and status."""
    return orphans.groupBy("source_table", F.date_format("at", "yyyy-MM").alias("month"), "status").agg(F.count(F.lit(1)).alias("n_rows"))
