"""Profiles of unknown attributes: coverage and spread of keys, redundant pairs, comparison with a configuration."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.text import match_key

#: Attributes that identify or sell a product, or are handled elsewhere; never recommended (fixed values).
UNWANTED_KEYS = [
    "parent_asin", "asin", "price", "average_rating", "rating_number", "bought_together",
    "details/asin", "details/isbn*", "details/upc", "details/ean", "details/item model number",
    "details/best sellers rank*", "details/date first available", "details/customer reviews",
    "details/product dimensions", "details/package dimensions", "details/item weight",
    "details/shipping weight", "details/item dimensions*", "details/batteries",
    "details/manufacturer part*", "details/country of origin", "details/discontinued*",
    "features", "description", "title", "images*", "videos*",
    "author/avatar", "author/about", "*/avatar", "*url*", "*/image*", "subtitle",
]
#: Values that prove no kinship between two attributes (fixed values).
GENERIC = ["yes", "no", "true", "false", "oui", "non", "enabled", "not enabled", "unknown", "none", "n a", "0", "1", "on", "off"]


def unwanted(key: Column, patterns: list[str] = UNWANTED_KEYS) -> Column:
    """Whether an attribute's name fits one of the patterns, case aside."""
    return F.lower(key).rlike("^(?:" + "|".join(fnmatch.translate(p).replace("\\Z", "$").replace("\\z", "$").replace("(?s:", "(?s:") for p in patterns) + ")")


def key_examples(attributes: DataFrame, most: int = 8) -> DataFrame:
    """key, kind (raw, atomic), rank, value, n: the commonest values of each attribute, as written and taken apart."""
    a = attributes.filter("key IS NOT NULL AND value IS NOT NULL")
    atomic = a.select("key", F.lit("atomic").alias("kind"), F.explode(atoms(F.col("value"))).alias("value"))
    counted = a.select("key", F.lit("raw").alias("kind"), "value").unionByName(atomic).groupBy("key", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("key", "kind").orderBy(F.desc("n"), "value"))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= most).select("key", "kind", "rank", "value", "n")


def name_similarity(a: Column, b: Column) -> Column:
    """Words that two attributes' names share, over all of their words; ``details`` says nothing."""
    of = lambda c: F.array_except(F.split(match_key(F.translate(c, "/", " ")), " "), F.array(F.lit("details"), F.lit("")))
    x, y = of(a), of(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(0.0)


def atoms(v: Column) -> Column:
    """Parts at , ; or | of two letters or more, if there is more than one; else the value itself."""
    parts = F.filter(F.transform(F.split(v, "[,;|]"), lambda p: F.trim(p)), lambda p: F.length(p) >= 2)
    return F.when(F.size(parts) > 1, parts).otherwise(F.array(v))


def key_profile(attributes: DataFrame, total: int | Column) -> DataFrame:
    """key, docs, coverage, multivalued (over a fifth of its products), distinct_raw, distinct_keys, uniqueness, mean_length, reasons.

    attributes: pid, key, value. reasons is why a key isn't recommended: rare, constant, unique, long, unwanted.
    """
    per = attributes.filter("key IS NOT NULL AND value IS NOT NULL").groupBy("key", "pid").agg(F.count(F.lit(1)).alias("n"))
    docs = per.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), (F.avg((F.col("n") > 1).cast("int")) > 0.2).alias("multivalued"))
    spread = attributes.filter("key IS NOT NULL AND value IS NOT NULL").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    stats = spread.withColumn("k", match_key(F.col("value"))).groupBy("key").agg(
        F.count(F.lit(1)).alias("distinct_raw"), F.count_distinct("k").alias("distinct_keys"), F.sum("n").alias("rows"), (F.sum(F.length("value") * F.col("n")) / F.sum("n")).alias("mean_length")
    )
    n = F.lit(total) if isinstance(total, int) else total
    j = docs.join(stats, "key").withColumn("coverage", F.col("docs") / n).withColumn("uniqueness", F.col("distinct_raw") / F.col("rows"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("coverage") < 0.02, "rare"), F.when(F.col("distinct_keys") <= 1, "constant"),
            F.when((F.col("uniqueness") > 0.6) & (F.col("distinct_keys") > 50) & ~F.col("multivalued"), "unique"), F.when(F.col("mean_length") > 80, "long"), F.when(unwanted(F.col("key")), "unwanted"),
        )
    )
    return j.select("key", "docs", "coverage", "multivalued", "distinct_raw", "distinct_keys", "uniqueness", "mean_length", F.array_join(reasons, ",").alias("reasons"))


def redundancy(attributes: DataFrame, least_size: int = 4, jaccard: float = 0.3, containment: float = 0.75, same_name: float = 0.8, keys: DataFrame | None = None) -> DataFrame:
    """key_a, key_b, shared, jaccard, containment, fuse of pairs of keys whose values overlap: by much, or by any if their names are alike.

    keys (key): the attributes to compare, such as the recommended ones; all without it. Pairs that have only GENERIC values are left out.
    An inverted index from atom to the keys that hold it; the keys of an atom are few, equal sets of keys count once.
    """
    a = attributes.filter("key IS NOT NULL AND value IS NOT NULL").select("key", F.explode(atoms(F.col("value"))).alias("atom")).select("key", match_key(F.col("atom")).alias("atom")).filter("atom <> ''").distinct()
    if keys is not None:
        a = a.join(keys.select("key").distinct(), "key", "left_semi")
    plain = a.filter(~F.col("atom").isin(GENERIC)).select("key").distinct()
    sizes = a.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.join(plain.withColumn("plain", F.lit(True)), "key", "left").withColumn("plain", F.coalesce("plain", F.lit(False)))
    sets = a.groupBy("atom").agg(F.array_sort(F.collect_set("key")).alias("ks")).filter(F.size("ks") > 1).groupBy("ks").agg(F.count(F.lit(1)).alias("n"))
    first = sets.select("n", "ks", F.posexplode("ks").alias("i", "key_a"))
    shared = first.select("n", "key_a", F.explode(F.slice("ks", F.col("i") + 2, F.size("ks"))).alias("key_b")).groupBy("key_a", "key_b").agg(F.sum("n").alias("shared"))
    x, y = (sizes.select(F.col("key").alias(f"key_{s}"), F.col("size").alias(f"size_{s}"), F.col("plain").alias(f"plain_{s}")) for s in "ab")
    j = shared.join(x, "key_a").join(y, "key_b").filter(F.least("size_a", "size_b") >= least_size)
    j = j.withColumn("jaccard", F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))).withColumn("containment", F.col("shared") / F.least("size_a", "size_b"))
    alike = name_similarity(F.col("key_a"), F.col("key_b")) >= same_name
    return j.filter("plain_a OR plain_b").filter((F.col("jaccard") >= jaccard) | (F.col("containment") >= containment) | alike).select(
        "key_a", "key_b", "shared", "jaccard", "containment", ((F.col("jaccard") >= 0.5) | (F.col("containment") >= 0.85)).alias("fuse")
    )


def compared(profile: DataFrame, declared: DataFrame) -> DataFrame:
    """key, status, coverage: missing (recommended, not declared), dead (declared, never seen), covered. declared: key."""
    d = declared.select(F.lower("key").alias("k")).distinct().withColumn("declared", F.lit(True))
    p = profile.withColumn("k", F.lower(F.regexp_replace("key", r"\?+$", "")))
    j = p.join(d, "k", "full")
    status = F.when(F.col("key").isNull(), "dead").when(F.col("declared").isNull() & (F.col("reasons") == ""), "missing").when(F.col("declared").isNotNull(), "covered")
    return j.select(F.coalesce("key", "k").alias("key"), status.alias("status"), F.coalesce("coverage", F.lit(0.0)).alias("coverage")).filter("status IS NOT NULL")


def suggested(redundant: DataFrame, profile: DataFrame) -> str:
    """A YAML draft of relations for recommended keys; keys to be fused share one relation. Attribute keys are schema, few enough for the driver."""
    import re

    rows = [r.key for r in profile.filter("reasons = ''").orderBy(F.desc("coverage"), "key").collect()]
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in redundant.filter("fuse").collect():
        root[find(r.key_b)] = find(r.key_a)
    groups: dict[str, list[str]] = {}
    for k in rows:
        groups.setdefault(find(k), []).append(k)
    name = lambda k: "has" + "".join(w[:1].upper() + w[1:] for w in re.findall(r"[A-Za-z0-9]+", k.split("/")[-1]))
    return "relations:\n" + "".join(f"  {name(ks[0])}:\n    sources: [{', '.join(repr(k) for k in ks)}]\n    ops: [title_case, canon_by_freq]\n" for ks in groups.values())
