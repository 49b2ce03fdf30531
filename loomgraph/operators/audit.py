"""Statistical audit of a graph: merges missed, merges suspected, polluted values, a score per relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.text import deaccent

#: Values that say nothing, unless a relation holds numbers (fixed values).
NOISE = [
    "n/a", "na", "none", "null", "unknown", "-", "--", "other", "others", "misc", "miscellaneous", "see description", "not applicable",
    "various", "assorted", "default", "0", "1", "no", "yes",
]
#: Longest value that isn't suspect.
LONG = 80
#: Values of digits and signs, and bands of numbers such as 0-50, 200+ and 4.5-5.
NUMBER, BAND = r"^[\d\s.,:/+-]+$", r"(?i)^\s*\d[\d.,]*\s*(?:[-a-z]{1,3}\s*\d[\d.,]*|\+)\s*$"


def relaxed_key(c: Column) -> Column:
    """Digits and letters from a to z of the value in lower case without accents; blanks go too."""
    return F.regexp_replace(F.lower(deaccent(c)), "[^0-9a-z]+", "")


def words(c: Column) -> Column:
    """Runs of digits and letters from a to z, in order."""
    return F.filter(F.split(F.lower(deaccent(c)), "[^0-9a-z]+"), lambda w: w != "")


def relation_values(kg: DataFrame) -> DataFrame:
    """relation, value, n."""
    return kg.filter("relation IS NOT NULL AND value IS NOT NULL").groupBy("relation", "value").agg(F.count(F.lit(1)).alias("n"))


def numeric_relations(values: DataFrame) -> DataFrame:
    """relation, is_numeric: at least half of its distinct values are numbers or bands of numbers."""
    v = F.trim("value")
    return values.groupBy("relation").agg((F.count_if(v.rlike(NUMBER) | v.rlike(BAND)) * 2 >= F.count(F.lit(1))).alias("is_numeric"))


def fault(value: Column, is_numeric: Column) -> Column:
    """The first fault of a value: empty, noise, html, long, numeric, short; null if none. Relations that hold numbers may hold noise words,
    bare numbers and single signs."""
    v = F.trim(value)
    return (
        F.when(v == "", "empty").when(~is_numeric & F.lower(v).isin(NOISE), "noise").when(v.rlike("<[^>]+>|&[a-z]+;|&#\\d+;"), "html").when(F.length(v) > LONG, "long")
        .when(~is_numeric & v.rlike(NUMBER), "numeric").when(~is_numeric & (F.length(v) <= 1), "short")
    )


def pollution(values: DataFrame) -> DataFrame:
    """relation, fault, distinct_values, occurrences."""
    judged = values.join(numeric_relations(values), "relation").withColumn("fault", fault(F.col("value"), F.col("is_numeric")))
    return judged.filter("fault IS NOT NULL").groupBy("relation", "fault").agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("occurrences"))


def missed_merges(values: DataFrame, top: int = 15) -> DataFrame:
    """relation, family, k, n_values, occurrences: groups of values that may be one, the largest of each family.

    Families: the same relaxed key; the same set of words, unless these are just the values of one relaxed key; the same first word of more
    than three letters, with several relaxed keys. A group is counted, never gathered.
    """
    keyed = values.withColumn("key", relaxed_key(F.col("value"))).withColumn("w", words(F.col("value")))

    def group(family: str, k: Column) -> DataFrame:
        counted = keyed.withColumn("k", k).filter("k <> ''").groupBy("relation", "k").agg(
            F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("occurrences"), F.min("key").alias("least"), F.max("key").alias("most")
        )
        return counted.filter("n_values > 1").withColumn("family", F.lit(family))

    same = group("key", F.col("key"))
    bag = group("words", F.array_join(F.array_sort(F.array_distinct("w")), " "))
    known = same.select("relation", F.col("k").alias("least"), F.col("n_values").alias("n_same"))
    bag = bag.join(known, ["relation", "least"], "left").filter("least <> most OR n_same IS NULL OR n_same <> n_values").drop("n_same")
    first = group("first word", F.when(F.length(F.get("w", F.lit(0))) > 3, F.get("w", F.lit(0)))).filter("least <> most")
    rank = F.row_number().over(Window.partitionBy("relation", "family").orderBy(F.desc("occurrences"), "k"))
    every = same.unionByName(bag).unionByName(first)
    return every.withColumn("_r", rank).filter(F.col("_r") <= top).select("relation", "family", "k", "n_values", "occurrences")


def suspicious_merges(mapping: DataFrame, top: int = 15) -> DataFrame:
    """relation, value, target, reason of merges whose names share no word, or only one of up to three letters where both have several. Names
    of one relaxed key, and names without words, are no suspects."""
    a, b = F.array_distinct(words(F.col("value"))), F.array_distinct(words(F.col("target")))
    both = F.array_intersect(a, b)
    reason = F.when(F.size(both) == 0, "no common word").when((F.size(both) == 1) & (F.least(F.size(a), F.size(b)) >= 2) & (F.length(both[0]) <= 3), "weak overlap")
    named = (relaxed_key(F.col("value")) != relaxed_key(F.col("target"))) & (F.size(a) > 0) & (F.size(b) > 0)
    hits = mapping.filter(named).withColumn("reason", reason).filter("reason IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("relation").orderBy("value", "target"))
    return hits.withColumn("_r", rank).filter(F.col("_r") <= top).select("relation", "value", "target", "reason")


def scores(values: DataFrame, products: int = 0, merges: DataFrame | None = None) -> DataFrame:
    """relation, triples, distinct_values, score (0 to 100).

    100, less 30 or 15 for more than 70 or 50 % of values that occur once; 25 for a relation that identifies products (values over the lesser of
    triples and products above 0.8; not asked without products); up to 30 for values that could still be merged, 300 times their share
    (the same relaxed key or set of words, one value less a group); up to 20 for suspicious merges, 4 each; up to 25 for polluted
    values, 100 times their share. Rounded half to even.
    """
    base = values.groupBy("relation").agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("triples"), F.avg((F.col("n") == 1).cast("int")).alias("single"))
    missed = missed_merges(values).filter("family <> 'first word'").groupBy("relation").agg(F.sum(F.col("n_values") - 1).alias("missed"))
    dirty = pollution(values).groupBy("relation").agg(F.sum("distinct_values").alias("dirty"))
    j = base.join(missed, "relation", "left").join(dirty, "relation", "left")
    if merges is None:
        j = j.withColumn("odd", F.lit(0))
    else:
        j = j.join(suspicious_merges(merges).groupBy("relation").agg(F.count(F.lit(1)).alias("odd")), "relation", "left")
    j = j.fillna(0, ["missed", "dirty", "odd"])
    lost = [
        F.when(F.col("single") > 0.7, 30).when(F.col("single") > 0.5, 15).otherwise(0),
        F.when(F.col("distinct_values") / F.least("triples", F.lit(products)) > 0.8, 25).otherwise(0) if products else F.lit(0),
        F.least(F.lit(30.0), 300 * F.col("missed") / F.col("distinct_values")),
        F.least(F.lit(20.0), 4.0 * F.col("odd")),
        F.least(F.lit(25.0), 100 * F.col("dirty") / F.col("distinct_values")),
    ]
    score = F.lit(100.0)
    for x in lost:
        score = score - x
    return j.select("relation", "triples", "distinct_values", F.bround(F.greatest(F.lit(0.0), score), 0).cast("int").alias("score"))


def read_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row: lines, comments, malformed (fewer than three fields), duplicates (repeats of a well-formed line) of a triple file read as text."""
    fields = F.split(text, "\t")
    kind = F.when(F.startswith(F.col(text), F.lit("#")), "comment").when(F.size(fields) < 3, "malformed").otherwise("triple")
    each = lines.filter(F.col(text) != "").withColumn("kind", kind).groupBy("kind", text).agg(F.count(F.lit(1)).alias("n"))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), of("comment").alias("comments"), of("malformed").alias("malformed"),
        (of("triple") - F.count_if(F.col("kind") == "triple")).alias("duplicates"),
    )


def global_score(scored: DataFrame) -> DataFrame:
    """score: the mean weighted by triples."""
    return scored.agg((F.sum(F.col("score") * F.col("triples")) / F.sum("triples")).alias("score"))
