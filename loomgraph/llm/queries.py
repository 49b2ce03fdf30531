"""Queries of the training-data problems, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.common import norm_id, table
from loomgraph.llm import bpe, canonical, garble, listings, markup, mixture, names, overlap


def _names(spark: SparkSession, d: str) -> DataFrame:
    people = ["hasAuthor", "hasDirector"]
    return names.name_groups(table(spark, d, "kg_triples").filter(F.col("relation").isin("hasBrand", *people)).select("relation", "value"), people)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variant_pairs(_names(spark, d))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of every spelling, and how many spellings it has."""
    groups = _names(spark, d)
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_spellings"), F.min("value").alias("name"))
    return groups.join(sizes, "group_id").select("relation", "value", F.col("name").alias("group_name"), "n_spellings")


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    triples = table(spark, d, "kg_triples").select("row_id", "relation", "value")
    return canonical.map_values(triples, table(spark, d, "canon_values"), table(spark, d, "rule_terms"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    entries = table(spark, d, "canon_values").select("relation", F.col("canonical").alias("value")).distinct()
    return _mapped(spark, d).join(F.broadcast(entries), ["relation", "value"], "left_anti").select("row_id", "canonical_id")  # a fixed list


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct values per entry, and per relation those that fit none (canonical_id 0)."""
    return _mapped(spark, d).groupBy("relation", "canonical_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("value").alias("n_values"))


def _residue(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        markup.residue(table(spark, d, name).select(F.lit(name).alias("source_table"), F.col(key).alias("row_id"), F.col(text).alias("text")), ["source_table", "row_id"])
        for name, key, text in (("documents", "doc_id", "text"), ("kg_triples", "row_id", "value"))
    ]
    return parts[0].unionByName(parts[1])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _residue(spark, d).select("source_table", "row_id", "kind")


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """The text of every row with markup, without it; one row each."""
    return _residue(spark, d).groupBy("source_table", "row_id").agg(F.sort_array(F.collect_set("kind")).alias("kinds"), F.first("clean").alias("text"))  # at most four kinds


def description(c: str) -> Column:
    """What follows the title: everything after the first `` . ``, or the whole text without one."""
    return F.element_at(F.split(c, r" \. ", 2), -1)


def _items(spark: SparkSession, d: str) -> DataFrame:
    link = table(spark, d, "kg_link").select(norm_id("product_id").alias("product_id"), "product_name", "loaded_at").filter("product_id IS NOT NULL")
    text = table(spark, d, "kg_text").select(norm_id("product_id").alias("product_id"), "text", "loaded_at").filter("product_id IS NOT NULL AND text IS NOT NULL")
    latest = lambda c: F.max_by(c, F.struct(F.col(c).isNotNull(), F.col("loaded_at"), F.xxhash64(c)))
    products = link.groupBy("product_id").agg(latest("product_name").alias("title"))
    texts = text.groupBy("product_id").agg(latest("text").alias("text"))
    listed = products.join(texts, "product_id", "full").select("product_id", F.coalesce("title", F.substring_index("text", " . ", 1)).alias("title"), description("text").alias("text"))
    taxonomy = table(spark, d, "kg_triples").filter("relation = 'hasSubtype'").select(F.col("value").alias("kind"))
    return listings.item_groups(listed, taxonomy, table(spark, d, "canon_values"), table(spark, d, "rule_terms"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return listings.item_pairs(_items(spark, d))


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of every listing, named by its first product, and its size."""
    g = _items(spark, d)
    sizes = g.groupBy("group_id").agg(F.min("product_id").alias("first_product"), F.count_distinct("product_id").alias("n_products"))
    return g.join(sizes, "group_id").select("product_id", "first_product", "n_products")


def _audiences(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "interactions").select(norm_id("item").alias("set_id"), norm_id("user").alias("member"))
    return overlap.overlaps(t)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _audiences(spark, d).select(F.col("set_a").alias("item_a"), F.col("set_b").alias("item_b"))


def p7_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return _audiences(spark, d).select(F.col("set_a").alias("item_a"), F.col("set_b").alias("item_b"), F.col("n_a").alias("users_a"), F.col("n_b").alias("users_b"), F.col("n_shared").alias("shared_users"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "source_targets")).select("doc_id", "source", "copy_no", "text")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture_shares(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return garble.garbled(table(spark, d, "documents"), fill_lost=False).select("doc_id")


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return garble.garbled(table(spark, d, "documents")).select("doc_id", "restored")


QUERIES = {f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_report, p5_found, p5_clean, p6_found, p6_groups, p7_found, p7_overlaps, p8_ids, p9_mixture, p9_shares, p10_found, p10_restored)}

WHITE = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_P7 = f"""
WITH p AS (
  SELECT DISTINCT upper(regexp_replace(item, '{WHITE}', '', 'g')) AS i, upper(regexp_replace("user", '{WHITE}', '', 'g')) AS u
  FROM interactions WHERE item IS NOT NULL AND "user" IS NOT NULL),
b AS (SELECT i, u, count(*) OVER (PARTITION BY i) AS n FROM p QUALIFY n >= 50)
SELECT x.i AS item_a, y.i AS item_b, x.n AS users_a, y.n AS users_b, count(*) AS shared_users
FROM b x JOIN b y ON x.u = y.u AND x.i < y.i GROUP BY ALL HAVING 2 * count(*) >= least(x.n, y.n)
"""
ORACLE = {"p7_found": f"SELECT item_a, item_b FROM ({_P7})", "p7_overlaps": _P7}
