"""Graphs on disk: one Parquet table per part, and the folder with the products that have all three modalities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import graph as ops
from loomgraph.plans.build import SIGNALS, Graph

PARTS = ("kg", "link", "text", "image", "taxonomy")


@dataclass
class Stored:
    kg: DataFrame  # product_id, subject, relation, value
    link: DataFrame
    text: DataFrame
    image: DataFrame
    taxonomy: DataFrame


def write_graph(graph: Graph, folder: str) -> None:
    graph.kg.withColumnRenamed("pid", "product_id").write.mode("overwrite").parquet(f"{folder}/kg")
    for part in PARTS[1:]:
        getattr(graph, part).write.mode("overwrite").parquet(f"{folder}/{part}")


def read_graph(spark: SparkSession, folder: str) -> Stored:
    return Stored(*[spark.read.parquet(f"{folder}/{p}") for p in PARTS])


def finalise(spark: SparkSession, folder: str, signals: tuple[str, ...] = SIGNALS) -> DataFrame:
    """Writes ``trimodal`` beside the parts of a graph: products with text and picture only, signals in a table of their own, subjects without
    a leading #. One row comes back: before, with_text, with_image, after, after_with_triples, retention.

    The parts stay as they are and ``trimodal`` is replaced as a whole, so a second run, or one after a failure, gives the same.
    """
    g = read_graph(spark, folder)
    out = f"{folder}/trimodal"
    link = ops.trimodal(g.link, g.text, g.image)
    kg, signal = ops.signal_split(ops.kept_triples(g.kg, link), list(signals))
    plain = lambda df: df.withColumn("subject", ops.plain_subject(F.col("subject")))
    tables = {"kg": plain(kg), "signal": plain(signal), "link": plain(link), "text": ops.kept_triples(g.text, link), "image": ops.kept_triples(g.image, link), "taxonomy": g.taxonomy}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    return ops.retention(g.kg, g.link, g.text, g.image)
