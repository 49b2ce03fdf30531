"""Interactions for recommender experiments: deduplication, k-core, chronological splits; overlap of categories."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.common import discard, exists, materialize

#: Times above this are in milliseconds.
MILLISECONDS = 10**11


def last_interactions(inter: DataFrame, released: DataFrame | None = None) -> DataFrame:
    """user, item, rating, ts of the latest interaction of each pair (the higher rating on a tie), times in seconds.

    Null users, items and times don't count; a null rating is 0. released (item): other items are left out. One aggregation with
    partial results, so an item or user of very many rows costs a row per task and pair.
    """
    rows = inter.filter("user IS NOT NULL AND item IS NOT NULL AND ts IS NOT NULL").select(
        "user", "item", F.coalesce("rating", F.lit(0.0)).alias("rating"), F.when(F.col("ts") > MILLISECONDS, F.floor(F.col("ts") / 1000)).otherwise(F.col("ts")).cast("bigint").alias("ts")
    )
    if released is not None:
        rows = rows.join(released.select("item").distinct(), "item", "left_semi")
    return rows.groupBy("user", "item").agg(F.max(F.struct("ts", "rating")).alias("m")).select("user", "item", "m.rating", "m.ts")


def k_core(pairs: DataFrame, k: int) -> DataFrame:
    """Rows whose user and item both have k rows or more among the rows that remain; both are counted on the same set in each round.

    pairs: user, item and other columns, one row per pair. Rounds go on until nothing changes; each is written to the shared folder and
    the one before it removed. Empty when nothing is left.
    """
    now = materialize(pairs, "core")
    while True:
        ends = F.array(F.struct(F.lit("user").alias("kind"), F.col("user").cast("string").alias("id")), F.struct(F.lit("item").alias("kind"), F.col("item").cast("string").alias("id")))
        counted = now.select(F.explode(ends).alias("e")).groupBy("e.kind", "e.id").agg(F.count(F.lit(1)).alias("c"))  # both in one pass
        few = materialize(counted.filter(F.col("c") < k).select("kind", "id"), "few")
        if few.isEmpty():
            return now
        rare = lambda kind: few.filter(F.col("kind") == kind).select(F.col("id").alias(kind))  # noqa: B023, E731
        kept = materialize(now.join(rare("user"), "user", "left_anti").join(rare("item"), "item", "left_anti").select(*pairs.columns), "core")
        discard(now)
        discard(few)
        now = kept


def chronological_split(inter: DataFrame, test: float = 0.1, valid: float = 0.1) -> DataFrame:
    """inter with split: each user's last share is test, the share before it valid (at least one each), the rest train; ties by item."""
    order = Window.partitionBy("user").orderBy("ts", "item")
    n = F.count(F.lit(1)).over(Window.partitionBy("user"))
    size = lambda share: F.greatest(F.lit(1), F.floor(n * F.lit(share)))
    back = n - F.row_number().over(order)  # rows of the user that come later
    return inter.withColumn("split", F.when(back < size(test), "test").when(back < size(test) + size(valid), "valid").otherwise("train"))


def entity_overlap(values: DataFrame) -> DataFrame:
    """category_a, category_b, shared, jaccard, size_a, size_b of each pair of categories with shared objects.

    values: category, object. An object of c categories makes c(c-1)/2 pairs; categories are few.
    """
    v = values.filter("category IS NOT NULL AND object IS NOT NULL").select("category", "object").distinct()
    sizes = v.groupBy("category").agg(F.count(F.lit(1)).alias("size"))
    return _pairs(v, "object", sizes)


def _pairs(v: DataFrame, by: str, sizes: DataFrame) -> DataFrame:
    # all categories of an object in one sorted array: bounded by the number of categories
    sets = v.groupBy(by).agg(F.array_sort(F.collect_set("category")).alias("cs")).filter(F.size("cs") > 1)
    sets = sets.groupBy("cs").agg(F.count(F.lit(1)).alias("n"))  # equal sets once
    first = sets.select("n", "cs", F.posexplode("cs").alias("i", "category_a"))
    pairs = first.select("n", "category_a", F.explode(F.slice("cs", F.col("i") + 2, F.size("cs"))).alias("category_b"))
    shared = pairs.groupBy("category_a", "category_b").agg(F.sum("n").alias("shared"))
    a, b = (sizes.select(F.col("category").alias(f"category_{x}"), F.col("size").alias(f"size_{x}")) for x in "ab")
    return (
        shared.join(a, "category_a").join(b, "category_b")
        .select("category_a", "category_b", "shared", (F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))).alias("jaccard"), "size_a", "size_b")
    )


def overlap_by_relation(values: DataFrame, top: int = 6) -> DataFrame:
    """category_a, category_b, relation, shared: the relations that share most (relation, object) pairs, by pair of categories."""
    v = values.filter("category IS NOT NULL AND object IS NOT NULL AND relation IS NOT NULL").select("category", "relation", "object").distinct()
    sets = v.groupBy("relation", "object").agg(F.array_sort(F.collect_set("category")).alias("cs")).filter(F.size("cs") > 1).groupBy("relation", "cs").agg(F.count(F.lit(1)).alias("n"))
    first = sets.select("relation", "n", "cs", F.posexplode("cs").alias("i", "category_a"))
    pairs = first.select("relation", "n", "category_a", F.explode(F.slice("cs", F.col("i") + 2, F.size("cs"))).alias("category_b"))
    shared = pairs.groupBy("category_a", "category_b", "relation").agg(F.sum("n").alias("shared"))
    rank = F.row_number().over(Window.partitionBy("category_a", "category_b").orderBy(F.desc("shared"), "relation"))
    return shared.withColumn("_r", rank).filter(F.col("_r") <= top).drop("_r")


def shared_users(inter: DataFrame, active: int = 5) -> DataFrame:
    """category_a, category_b, shared, shared_active (active rows or more in both), jaccard, share_of_smaller."""
    per = inter.filter("category IS NOT NULL AND user IS NOT NULL").groupBy("category", "user").agg(F.count(F.lit(1)).alias("n"))
    sizes = per.groupBy("category").agg(F.count(F.lit(1)).alias("size"))
    every = _pairs(per.select("category", "user"), "user", sizes)
    busy = per.filter(F.col("n") >= active)
    some = _pairs(busy.select("category", "user"), "user", busy.groupBy("category").agg(F.count(F.lit(1)).alias("size"))).select("category_a", "category_b", F.col("shared").alias("shared_active"))
    return every.join(some, ["category_a", "category_b"], "left").select(
        "category_a", "category_b", "shared", F.coalesce("shared_active", F.lit(0)).alias("shared_active"), "jaccard", (F.col("shared") / F.least("size_a", "size_b")).alias("share_of_smaller")
    )


def users_of_several(inter: DataFrame) -> DataFrame:
    """users, users_in_several, share: one row."""
    per = inter.filter("category IS NOT NULL AND user IS NOT NULL").groupBy("user").agg(F.count_distinct("category").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("n") > 1).alias("users_in_several"), F.avg((F.col("n") > 1).cast("int")).alias("share"))


def half_matrix(pairs: DataFrame, value: str, categories: list[str]) -> DataFrame:
    """The upper triangle of a table of pairs, one row per category_a."""
    return pairs.groupBy("category_a").pivot("category_b", categories).agg(F.first(value))


def density(inter: DataFrame) -> DataFrame:
    """users, items, interactions, density: one row."""
    n = inter.agg(F.count_distinct("user").alias("users"), F.count_distinct("item").alias("items"), F.count(F.lit(1)).alias("interactions"))
    return n.withColumn("density", F.col("interactions") / (F.col("users") * F.col("items")))


def overlap_summary(pairs: DataFrame, least: float = 0.01) -> DataFrame:
    """One row: pairs, pairs_from (with a Jaccard index of least or more), and the pair with the greatest (category_a, category_b, jaccard, shared)."""
    top = F.max_by(F.struct("category_a", "category_b", "jaccard", "shared"), F.struct("jaccard", "shared", "category_a", "category_b"))
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("jaccard") >= least).alias("pairs_from"), top.alias("t")).select("pairs", "pairs_from", "t.*")


def per_item(inter: DataFrame, kg: DataFrame) -> DataFrame:
    """One row: items, interactions_per_item, kg_triples, kg_relations, kg_triples_per_item, of the items that have interactions. kg: product_id, relation."""
    items = inter.select(F.col("item").alias("product_id")).distinct()
    of = inter.agg(F.count_distinct("item").alias("items"), F.count(F.lit(1)).alias("interactions"))
    own = kg.join(items, "product_id", "left_semi").agg(F.count(F.lit(1)).alias("kg_triples"), F.count_distinct("relation").alias("kg_relations"))
    ratio = lambda c: F.round(F.col(c) / F.greatest(F.col("items"), F.lit(1)), 2)
    return of.crossJoin(F.broadcast(own)).select("items", ratio("interactions").alias("interactions_per_item"), "kg_triples", "kg_relations", ratio("kg_triples").alias("kg_triples_per_item"))  # one row each


def users_per_category(spark: SparkSession, categories: dict[str, tuple[str, DataFrame]], folder: str) -> DataFrame:
    """category, user, n from interactions of each category, counted once per signature: categories holds (signature, interactions), and counts are
    kept below folder by category and signature, where later calls find them."""
    out = []
    for category, (signature, inter) in sorted(categories.items()):
        path = f"{folder}/{quote(category, safe='')}/{quote(signature, safe='')}"
        if not exists(spark, f"{path}/_SUCCESS"):
            inter.filter("user IS NOT NULL").groupBy("user").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        out.append(spark.read.parquet(path).select(F.lit(category).alias("category"), "user", "n"))
    return reduce(DataFrame.unionByName, out)
