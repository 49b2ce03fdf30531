"""Lookup tables learned from the data: one aggregation counts the variants of all relations, joins turn counts into tables.

Counts are rows (keys..., value, n, first): how often a value occurs and where it occurs first; ``first`` breaks ties that would
otherwise depend on the order of processing. Every table is a DataFrame; nothing is gathered on the driver but a map of bits of a fixed
size at most (find_vocabulary).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.common import materialize
from loomgraph.functions.persons import SUFFIX_WORDS
from loomgraph.functions.text import accent_score, match_key, tight_key
from loomgraph.operators.values import WEAK, split_by

#: Singulars whose plural means another thing (fixed values).
DISTINCT_PLURALS = ["arm", "brief", "custom", "glass", "good", "new", "short", "spectacle", "tight", "work"]
CONJUNCTIONS = (" & ", " and ", " + ", " et ")


def counts(values: DataFrame, keys: list[str], value: str = "value", order: str | None = None) -> DataFrame:
    """keys, value, n, first of every distinct value; null values aren't counted."""
    return values.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min(F.col(order) if order else F.lit(0)).cast("bigint").alias("first"))


def variant_map(c: DataFrame, keys: list[str], tight: Column | None = None) -> DataFrame:
    """keys, value, target: the commonest form of the same comparison key; then the one with more accents, the shorter, the last in the alphabet.

    tight: which rows compare without blanks. Values without a key and forms that stay as they are have no row.
    """
    key = match_key(F.col("value")) if tight is None else F.when(tight, tight_key(F.col("value"))).otherwise(match_key(F.col("value")))
    keyed = c.withColumn("k", key).filter("k <> ''")
    best = keyed.groupBy(*keys, "k").agg(F.max_by("value", F.struct("n", accent_score(F.col("value")), -F.length("value"), "value")).alias("target"))
    return keyed.join(best, [*keys, "k"]).filter("value <> target").select(*keys, "value", "target")


def recount(c: DataFrame, mapping: DataFrame, keys: list[str]) -> DataFrame:
    """The counts after a mapping."""
    joined = c.join(mapping, [*keys, "value"], "left").select(*keys, F.coalesce("target", "value").alias("value"), "n", "first")
    return joined.groupBy(*keys, "value").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def weak_splits(parts: DataFrame, keys: list[str], weak: list[str] | None = None, min_evidence: int = 3, min_len: int = 3, keep_whole: list[str] | None = None) -> DataFrame:
    """keys, value, fragments: values with a weak separator whose every fragment occurs alone at least min_evidence times.

    parts: keys, value, n (after the strong separators). Protected values, fewer than two fragments, and repeated fragments around
    conjunctions only (a name) aren't split.
    """
    weak = WEAK if weak is None else weak
    has_weak = F.lit(False)
    for s in weak:
        has_weak = has_weak | F.contains("value", F.lit(s))
    only_conjunctions = F.lit(True)
    for s in weak:
        if s not in CONJUNCTIONS:
            only_conjunctions = only_conjunctions & ~F.contains("value", F.lit(s))
    atoms = parts.filter(~has_weak).groupBy(*keys, match_key(F.col("value")).alias("k")).agg(F.sum("n").alias("seen"))
    protected = sorted({k for k in keep_whole or []})
    wholes = parts.filter(has_weak).select(*keys, "value").distinct().withColumn("fragments", split_by(F.col("value"), weak, min_len)).filter(F.size("fragments") >= 2)
    if protected:
        from loomgraph.functions.text import py_key

        wholes = wholes.filter(~match_key(F.col("value")).isin([py_key(p) for p in protected]))
    fragment_keys = F.transform("fragments", match_key)
    wholes = wholes.filter(~((F.size(F.array_distinct(fragment_keys)) < F.size("fragments")) & only_conjunctions))
    exploded = wholes.select(*keys, "value", "fragments", F.explode(fragment_keys).alias("k"))
    evidence = exploded.join(atoms, [*keys, "k"], "left").groupBy(*keys, "value", "fragments").agg(F.min(F.coalesce("seen", F.lit(0))).alias("least"))
    return evidence.filter(F.col("least") >= min_evidence).select(*keys, "value", "fragments")


def prefix_map(c: DataFrame, keys: list[str], min_count: int = 3, min_prefix_tokens: int = 1) -> DataFrame:
    """keys, value, target: the shortest whole-word prefix of a value that is a value itself and at least as frequent."""
    words = c.withColumn("k", match_key(F.col("value"))).filter("k <> ''").withColumn("w", F.split("k", " "))
    short = (
        words.filter((F.col("n") >= min_count) & (F.size("w") >= min_prefix_tokens)).groupBy(*keys, F.col("k").alias("p"))
        .agg(F.max_by("value", F.struct("n", -F.col("first"), "value")).alias("target"), F.max("n").alias("target_n"))
    )
    long = words.filter(F.size("w") > min_prefix_tokens).select(
        *keys, "value", "n", F.explode(F.transform(F.sequence(F.lit(min_prefix_tokens), F.size("w") - 1), lambda i: F.struct(i.alias("cut"), F.array_join(F.slice("w", 1, i), " ").alias("p")))).alias("x")
    ).select(*keys, "value", "n", "x.cut", "x.p")
    fits = long.join(short, [*keys, "p"]).filter(F.col("target_n") >= F.greatest("n", F.lit(min_count)))
    return fits.groupBy(*keys, "value").agg(F.min_by("target", "cut").alias("target"))


def surname_map(c: DataFrame, keys: list[str], min_count: int = 2) -> DataFrame:
    """keys, k (comparison key of a surname), target: the only full name with that surname, if it occurs min_count times."""
    words = c.withColumn("w", F.split("value", " ")).filter(F.size("w") >= 2)
    last = F.element_at("w", -1)
    tail = F.lower(F.regexp_replace(last, r"\.+$", "")).isin(sorted(SUFFIX_WORDS)) & (F.size("w") > 2)
    named = words.withColumn("k", match_key(F.when(tail, F.element_at("w", -2)).otherwise(last)))
    per = named.groupBy(*keys, "k").agg(F.count_distinct("value").alias("names"), F.sum("n").alias("seen"), F.min("value").alias("target"))
    return per.filter((F.col("names") == 1) & (F.col("seen") >= min_count)).select(*keys, "k", "target")


def plural_map(c: DataFrame, keys: list[str], min_count: int = 1, keep_distinct: list[str] | None = None) -> DataFrame:
    """keys, value, target: singular and plural merged where both occur, into the commoner (then shorter, then last in the alphabet);
    chains are followed to their end."""
    low = F.lower("value")
    ends = lambda s, n: F.endswith(low, F.lit(s)) & (F.length("value") > n)
    cut = lambda n, add="": F.concat(F.left(low, F.length(low) - n), F.lit(add))
    candidates = F.filter(
        F.array(F.when(ends("ies", 5), cut(3, "y")), F.when(ends("es", 4), cut(2)), F.when(ends("s", 3) & ~F.endswith(low, F.lit("ss")), cut(1))), lambda x: x.isNotNull()
    )
    exceptions = sorted({str(w).strip().lower() for w in keep_distinct or []} | set(DISTINCT_PLURALS))
    forms = c.groupBy(*keys, F.lower("value").alias("form")).agg(F.min_by(F.struct("value", "n"), F.struct("first", "value")).alias("one"))
    plural = c.filter(F.col("n") >= min_count).select(*keys, "value", "n", F.posexplode(candidates).alias("rank", "form")).filter(~F.col("form").isin(exceptions))
    pairs = plural.join(forms, [*keys, "form"]).filter((F.col("one.value") != F.col("value")) & (F.col("one.n") >= min_count))
    pick = pairs.groupBy(*keys, "value", "n").agg(F.min_by("one", "rank").alias("one"))
    a = F.struct(F.col("n").alias("n"), (-F.length("value")).alias("l"), F.col("value").alias("v"))
    b = F.struct(F.col("one.n").alias("n"), (-F.length("one.value")).alias("l"), F.col("one.value").alias("v"))
    edges = pick.select(*keys, F.least(a, b)["v"].alias("value"), F.greatest(a, b)["v"].alias("target"), F.col("value").alias("plural"))
    return closed(edges.groupBy(*keys, "value").agg(F.max_by("target", "plural").alias("target")), keys)


def closed(mapping: DataFrame, keys: list[str]) -> DataFrame:
    """A mapping with its chains followed to the end, by doubling: a chain of 2**n steps takes n rounds. A cycle, which the mappings of
    this module can't hold, has no end and raises ValueError."""
    now = materialize(mapping, "closure")
    longest, rounds = None, 0
    while True:
        ahead = now.select(*keys, F.col("value").alias("target"), F.col("target").alias("further"))
        step = now.join(ahead, [*keys, "target"], "left").select(*keys, "value", F.coalesce(F.when(F.col("further") != F.col("value"), F.col("further")), F.col("target")).alias("next"), "target")
        step = materialize(step, "closure")
        if step.filter("next <> target").isEmpty():
            return now
        rounds += 1
        longest = longest or step.count()  # no chain has more steps than the mapping has rows
        if 2**rounds > 2 * longest:
            raise ValueError("the mapping holds a cycle")
        now = step.select(*keys, "value", F.col("next").alias("target"))


def vocabulary(c: DataFrame, keys: list[str], min_count: int = 3, max_len: int = 40, min_words: int = 2) -> DataFrame:
    """keys, term, value: values that occur min_count times and have min_words words, by their words."""
    words = F.regexp_extract_all(F.lower("value"), F.lit("[a-z0-9]+"), F.lit(0))
    fit = c.filter((F.col("n") >= min_count) & (F.length("value") <= max_len)).withColumn("w", words).filter(F.size("w") >= min_words)
    return fit.groupBy(*keys, F.array_join("w", " ").alias("term")).agg(F.min_by("value", F.struct("first", "value")).alias("value"))


#: First words of terms of up to so many are broadcast (a hash and two lengths each), about 100 MB; more are joined by a shuffle.
BROADCAST_STARTS = 1_000_000
#: Bits of the map before that shuffle at most, 16 MB; it has sixteen for each first word below that.
MAP_BITS = 1 << 27


def _likely(places: DataFrame, starts: DataFrame, n: int) -> DataFrame:
    """places, without most of those whose start is none of the n starts, so that the join, which decides, shuffles the others only."""
    bits = min(MAP_BITS, 1 << max(6, (16 * n - 1).bit_length()))
    at = F.pmod("start", F.lit(bits))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))
    rows = starts.groupBy(F.floor(at / 64).cast("int").alias("word")).agg(F.bit_or(mask).alias("mask")).toArrow()
    filled = np.zeros(bits // 64, np.int64)
    filled[rows["word"].to_numpy()] = rows["mask"].to_numpy()
    shared = places.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def known(start: pd.Series) -> pd.Series:
        h = start.to_numpy() % bits
        return pd.Series((shared.value[h >> 6] >> (h & 63)) & 1 == 1)

    return places.filter(known("start"))


def find_vocabulary(texts: DataFrame, keys: list[str], terms: DataFrame, id_cols: list[str], text: str = "text", max_terms: int = 2, max_words: int | None = None) -> DataFrame:
    """id_cols, pos, value: terms of a learned vocabulary in free text, from left to right, the longest first, each word used once.

    The vocabulary may be of any size: words that start a term (by their hash) are found first, and only the runs from there, of up to
    max_words words, by default as many as the longest term has, are joined with it; the choice among the hits of one text happens in an ordered
    fold over that text's own hits. Both joins say how they are done, as Spark takes the exploded side for as small as the file of texts, and broadcasts it.
    """
    spaced = terms.select(*keys, "term", "value")
    glued = spaced.withColumn("term", F.replace("term", F.lit(" "), F.lit("")))
    forms = materialize(spaced.unionByName(glued).groupBy(*keys, "term").agg(F.min("value").alias("value")), "vocabulary")
    sized = forms.select(*keys, F.xxhash64(F.substring_index("term", " ", 1)).alias("start"), F.size(F.split("term", " ")).alias("len"))
    sized = sized if max_words is None else sized.filter(F.col("len") <= max_words)
    starts = sized.groupBy(*keys, "start").agg(F.min("len").alias("shortest"), F.max("len").alias("longest"))
    n_starts, most = starts.agg(F.count(F.lit(1)), F.max("longest")).first()
    ids = [*id_cols, *[k for k in keys if k not in id_cols]]
    most = most or 1
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    following = [F.slice("w", i + 1, F.size("w")).alias(f"w{i}") for i in range(most)]  # a column for each next word: a row of a long text carries no more
    places = (
        texts.select(*ids, words.alias("w")).filter(F.size("w") > 0)
        .select(*ids, F.size("w").alias("n"), *following)
        .select(*ids, "n", F.posexplode(F.arrays_zip(*[f"w{i}" for i in range(most)])).alias("at", "next"))
        .select(*ids, "at", (F.col("n") - F.col("at")).alias("left"), F.xxhash64("next.w0").alias("start"), F.array(*[f"next.w{i}" for i in range(most)]).alias("next"))
    )
    few = n_starts <= BROADCAST_STARTS
    begun = places.join(F.broadcast(starts), [*keys, "start"]) if few else _likely(places, starts, n_starts).join(starts.hint("merge"), [*keys, "start"])
    runs = (
        begun.filter(F.col("left") >= F.col("shortest"))
        .select(*ids, "at", "next", F.explode(F.sequence("shortest", F.least("longest", "left"))).alias("len"))
        .select(*ids, "at", "len", F.array_join(F.slice("next", 1, F.col("len")), " ").alias("term"))
    )
    hits = runs.join(forms.hint("merge"), [*keys, "term"])
    per_text = hits.groupBy(*id_cols).agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("len")).alias("short"), "value"))).alias("hits"))  # the hits of one text
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<at:int,value:string>>").alias("taken"))
    fold = F.aggregate(
        "hits", start,
        lambda s, h: F.when(h["at"] >= s["free"], F.struct((h["at"] - h["short"]).alias("free"), F.concat(s["taken"], F.array(F.struct(h["at"].alias("at"), h["value"].alias("value")))).alias("taken"))).otherwise(s),
        lambda s: s["taken"],
    )
    chosen = per_text.select(*id_cols, F.posexplode(fold).alias("i", "t")).select(*id_cols, "t.at", "t.value")
    first = chosen.groupBy(*id_cols, "value").agg(F.min("at").alias("at"))
    rank = F.row_number().over(Window.partitionBy(*id_cols).orderBy("at"))
    return first.withColumn("pos", rank - 1).filter(F.col("pos") < max_terms).select(*id_cols, "pos", "value")
