"""Shared plumbing: table access, identifier normalisation, materialisation, hot keys."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every code point with the Unicode White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

#: A key is hot when it holds more than one row in HOT_SHARE; so there are at most HOT_SHARE hot keys, whatever the input.
HOT_SHARE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm_id(c: Column | str) -> Column:
    """Identifier without white space (no-break spaces too), in upper case. Null stays null."""
    return F.upper(F.translate(F.col(c) if isinstance(c, str) else c, WHITE, ""))


def subject_id(c: Column | str) -> Column:
    """The normalised id after the last ``##`` of a subject; null where there is no ``##``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.contains(c, F.lit("##")), norm_id(F.substring_index(c, "##", -1)))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Unset, it is a folder of this machine for a local session (tests), whose
    executors all run here; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        base = "file://" + os.path.join(tempfile.gettempdir(), "loomgraph-shared")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the cluster cleans its checkpoint folder
        pass


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/loomgraph-{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    out.written_at = path
    return out


def discard(df: DataFrame | None) -> None:
    """Remove the files of a table from ``materialize`` that nothing reads any more; loops call it for the rounds they have passed."""
    if df is not None and (path := getattr(df, "written_at", None)):
        _remove(df.sparkSession, path)


def join_counted(left: DataFrame, counted: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Inner join of ``left`` with one row per key; column n of that row says how many rows of left have the key.

    Keys of more than 1/HOT_SHARE of all rows, at most HOT_SHARE by the pigeonhole principle, are broadcast, so their rows stay where they
    are; only the others are shuffled. counted should be written, as it is read three times.
    """
    total = counted.agg(F.sum(n)).first()[0] or 0
    hot = counted.filter(F.col(n) * HOT_SHARE > total)
    cool = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(counted.filter(F.col(n) * HOT_SHARE <= total), keys)
    return left.join(F.broadcast(hot), keys).unionByName(cool)


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """(key, salts) of the keys that hold more than 1/share of all rows: at most ``share`` rows by the pigeonhole principle.

    salts is the number of parts of total/share rows that the key's rows make.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    part = F.col("n") * share / total
    return counts.filter(part > 1).select(key, F.ceil(part).cast("int").alias("salts"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, component of an undirected graph: component is the smallest node of each connected part, nodes without edges are left out.

    edges: a, b of one orderable type. Smallest-neighbour labels with pointer jumping: the number of rounds grows with the logarithm of
    a part's diameter. Each round is written to the shared folder, so lineage stays short. A node of many neighbours is aggregated with
    partial sums, never gathered.
    """
    both = materialize(edges.select("a", "b").filter("a <> b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).filter("a <> b")).distinct(), label)
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "node"), label)
    passed = labels
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least")).withColumnRenamed("a", "node")
        hooked = labels.join(near, "node").select("node", "component", F.least("component", "least").alias("to"))
        # the component's own label may have sunk in this round: jump to it
        jumped = hooked.join(hooked.select(F.col("node").alias("n2"), F.col("to").alias("t2")), F.col("to") == F.col("n2"), "left").select(
            "node", F.coalesce(F.least("to", "t2"), F.col("to")).alias("component"), F.col("component").alias("before")
        )
        done = materialize(jumped, label)
        labels = done.select("node", "component")
        discard(passed)
        if done.filter("component <> before").isEmpty():
            discard(both)
            return labels
        passed = done
