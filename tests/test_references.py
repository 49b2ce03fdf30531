from datetime import datetime as dt

from pyspark.sql import functions as F

from loomgraph.common import hot_keys, norm_id, subject_id
from loomgraph.operators.references import orphan_references, orphan_report

REFS = "source_table string, row_id bigint, key string, at timestamp, extra string"
PARENTS = "key string, valid_from timestamp, valid_to timestamp, at string"


def status(spark, refs, parents):
    got = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS))
    return {(r.source_table, r.row_id): r.status for r in got.collect()}


def test_missing_late_deleted_and_back(spark):
    d = [dt(2023, 1, i) for i in range(1, 20)]
    parents = [("A", d[2], d[5], "x"), ("A", d[8], None, "x"), ("B", d[4], d[6], "x"), ("C", None, None, "x"), (None, d[0], None, "x"), ("D", d[3], d[3], "x")]
    refs = [
        ("t", 1, "A", d[0], "e"), ("t", 2, "A", d[2], "e"), ("t", 3, "A", d[5], "e"), ("t", 4, "A", d[9], "e"), ("t", 5, "B", d[7], "e"), ("t", 6, "Z", d[7], "e"),
        ("t", 7, None, d[7], "e"), ("t", 8, "A", None, "e"), ("t", 9, "C", d[3], "e"), ("u", 1, "A", d[0], "e"), ("t", 10, "D", d[3], "e"), ("t", 11, "Z", None, "e"),
    ]
    assert status(spark, refs, parents) == {
        ("t", 1): "late", ("t", 3): "deleted", ("t", 5): "deleted", ("t", 6): "missing", ("t", 8): "undated", ("t", 9): "late", ("u", 1): "late", ("t", 10): "deleted", ("t", 11): "missing",
    }


def test_empty_tables_and_repeated_rows(spark):
    d = dt(2023, 1, 1)
    assert status(spark, [], [("A", d, None, "x")]) == {}
    got = orphan_references(spark.createDataFrame([("t", 1, "A", d, "e")] * 2, REFS), spark.createDataFrame([], PARENTS))
    assert [r.status for r in got.collect()] == ["missing", "missing"]
    assert orphan_report(got).collect()[0].n_rows == 2


def test_hot_key_is_split_and_whole(spark):
    refs = spark.range(30_000).select(
        F.lit("t").alias("source_table"), F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.timestamp_seconds(F.col("id")).alias("at"),
    )
    parents = spark.createDataFrame([("HOT", dt(1970, 1, 1, 1, 0, 0), None)], "key string, valid_from timestamp, valid_to timestamp")
    got = orphan_references(refs, parents)
    assert got.filter("key = 'HOT'").count() == 1200  # those before 3600 seconds
    assert got.filter("key <> 'HOT'").count() == 20_000
    salts = hot_keys(refs, "key").collect()
    assert [(r.key, r.salts > 100) for r in salts] == [("HOT", True)]


def test_ids(spark):
    df = spark.createDataFrame([(" q1 x ", "A ##B ## q\t2"), (None, "no id"), ("", None)], "a string, s string")
    assert [tuple(r) for r in df.select(norm_id("a"), subject_id("s")).collect()] == [("Q1X", "Q2"), (None, None), ("", None)]
