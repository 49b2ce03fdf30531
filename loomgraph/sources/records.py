"""Records and tables in: JSON lines, JSON arrays, CSV and TSV, Python literals; flattening to paths; source patterns."""

from __future__ import annotations

import fnmatch
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions.text import tidy_values

#: Top-level fields that aren't attributes (fixed values).
SKIPPED = ("images", "videos", "bought_together")


def expand(paths: list[str]) -> list[str]:
    """Files of globs and folders in order; a local path that matches nothing is an error. Paths with a scheme pass through."""
    import glob

    out: list[str] = []
    for p in paths:
        if "://" in p:
            out.append(p)
            continue
        hits = sorted(glob.glob(p))
        if os.path.isdir(p):
            hits = sorted(f for e in ("jsonl", "jsonl.gz", "json.gz", "jsonl.zst", "tsv", "csv") for f in glob.glob(os.path.join(p, f"*.{e}")))
        if not hits:
            raise FileNotFoundError(p)
        out += hits
    return out


def category_of(path: Column, known: list[str]) -> Column:
    """The longest known name within the file's name, else what follows ``meta_``."""
    name = F.element_at(F.split(path, "/"), -1)
    out = None
    for k in sorted(known, key=len, reverse=True):
        test = F.contains(name, F.lit(k))
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    rest = F.nullif(F.regexp_extract(name, r"^meta_(.+?)\.jsonl", 1), F.lit(""))
    return rest if out is None else out.otherwise(rest)


def read_json_lines(spark: SparkSession, paths: list[str], known: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """category, row (order of reading), json: one row per line that holds a JSON object; other lines are left out.

    Compressed files (gz, zst) can't be split: give partitions to spread their rows.
    """
    lines = spark.read.text(expand(paths)).select(category_of(F.input_file_name(), known or []).alias("category"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("json"))
    lines = lines.filter(F.startswith(F.ltrim("json"), F.lit("{")) & F.from_json("json", "map<string,string>").isNotNull())
    return lines.repartition(partitions) if partitions else lines


def first_records(records: DataFrame, n: int, order: str = "row") -> DataFrame:
    """The first n records in the order of reading, for a trial run."""
    return records.orderBy(order).limit(n)


def sampled(records: DataFrame, n: int, key: str = "row", seed: int = 13) -> DataFrame:
    """n records with the smallest hashes of seed and key: the same ones in each run, and spread over all files."""
    return records.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """row, json of each object of a file that is one JSON array."""
    whole = spark.read.text(path, wholetext=True)
    items = whole.select(F.posexplode(F.from_json("value", "array<string>")).alias("row", "json"))
    return items.select(F.col("row").cast("bigint").alias("row"), "json").filter(F.startswith(F.ltrim("json"), F.lit("{")))


def read_table(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """row, json of a CSV or TSV file with a header: columns ``details/x`` become one object, empty cells go."""
    t = spark.read.csv(path, header=True, sep=sep or ("\t" if ".tsv" in path else ","))
    plain = [c for c in t.columns if "/" not in c]
    nested = [c for c in t.columns if c.startswith("details/")]
    cell = lambda c: F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`"))
    fields = [cell(c).alias(c) for c in plain]
    if nested:
        pairs = F.map_from_arrays(F.array(*[F.lit(c.split("/", 1)[1]) for c in nested]), F.array(*[cell(c) for c in nested]))
        fields.append(F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("details"))
    return t.select(F.monotonically_increasing_id().alias("row"), F.to_json(F.struct(*fields)).alias("json"))


def read_literals(spark: SparkSession, paths: list[str], pattern: str | None = None) -> DataFrame:
    """row, json of lines that are Python literals of dictionaries; lines that don't match ``pattern`` are skipped unparsed."""
    import ast
    import json

    lines = spark.read.text(expand(paths)).select(F.monotonically_increasing_id().alias("row"), "value")
    if pattern:
        lines = lines.filter(F.col("value").rlike(pattern))

    @F.pandas_udf(T.StringType())
    def parse(s):
        def one(v: str) -> str | None:
            try:
                x = ast.literal_eval(v)
                return json.dumps(x, ensure_ascii=False) if isinstance(x, dict) else None
            except (ValueError, SyntaxError, MemoryError, RecursionError):
                return None

        return s.map(one)

    return lines.select("row", parse("value").alias("json")).filter("json IS NOT NULL")


def _values(v: Column) -> Column:
    """The values of a JSON field as text: those of an array, or the one."""
    many = F.when(F.startswith(F.ltrim(v), F.lit("[")), F.from_json(v, "array<string>"))
    return F.filter(F.coalesce(many, F.array(v)), lambda x: x.isNotNull() & (x != ""))


def flat(json: Column, known: list[str] | None = None) -> Column:
    """array<struct<path, values>> of a JSON object in the order of its keys, down to two levels joined by ``/``.

    Texts glued into one entry with an empty key (``Shape Rectangular``) are taken apart at the longest known attribute name:
    one of the record's own keys, or of ``known``. A repeated key keeps its first place and its last value.
    """
    entries = lambda j: F.map_entries(F.from_json(j, "map<string,string>"))
    entry = lambda path, v: F.struct(path.alias("path"), _values(v).alias("values"))

    def inner(e: Column) -> Column:
        deep = F.when(F.startswith(F.ltrim(e["value"]), F.lit("{")), entries(e["value"]))
        return F.coalesce(F.transform(deep, lambda d: entry(F.concat(e["key"], F.lit("/"), d["key"]), d["value"])), F.array(entry(e["key"], e["value"])))

    top = F.filter(entries(json), lambda e: ~e["key"].isin(*SKIPPED) & e["value"].isNotNull())
    all_ = F.flatten(F.transform(top, inner))
    paths = F.array_distinct(F.transform(all_, lambda e: e["path"]))
    once = F.transform(paths, lambda p: F.element_at(F.filter(all_, lambda e: e["path"] == p), -1))
    plain = F.filter(once, lambda e: ~F.endswith(e["path"], F.lit("/")))
    names = F.array_union(F.transform(F.filter(plain, lambda e: F.startswith(e["path"], F.lit("details/"))), lambda e: F.substring(e["path"], 9, 1 << 20)), F.array(*[F.lit(k) for k in known or []]).cast("array<string>"))
    glued = F.flatten(F.transform(F.filter(once, lambda e: F.endswith(e["path"], F.lit("/"))), lambda e: e["values"]))

    def apart(text: Column) -> Column:
        fit = F.filter(names, lambda n: F.startswith(F.lower(text), F.concat(F.lower(n), F.lit(" "))))
        best = F.element_at(F.array_sort(F.transform(fit, lambda n: F.struct(F.length(n).alias("l"), n.alias("n")))), -1)
        return F.when(F.size(fit) > 0, F.struct(F.concat(F.lit("details/"), best["n"]).alias("path"), F.array(F.trim(F.substr(text, best["l"] + 1))).alias("values")))

    recovered = F.filter(F.transform(glued, apart), lambda e: e.isNotNull())
    return F.concat(plain, F.coalesce(recovered, F.array().cast("array<struct<path:string,values:array<string>>>")))


def source_key(path: str) -> str:
    return path.lower().rstrip("?").strip()


def _matching(keyed: Column, pattern: str) -> Column:
    return F.filter(keyed, lambda e: e["k"].rlike(pattern))


def from_sources(flattened: Column, patterns: list[str], first_only: bool = True) -> Column:
    """Values of the attributes that match the patterns, in their order: those of the first match with any, or of all.

    Case and a trailing ``?`` don't matter; patterns may hold wildcards, which take attributes in the record's own order.
    Variants of one key go together, and an attribute is used once.
    """
    keyed = F.transform(flattened, lambda e: F.struct(F.trim(F.regexp_replace(F.lower(e["path"]), r"\?+$", "")).alias("k"), e["values"].alias("values")))
    hits = F.array().cast("array<string>")
    for p in patterns:
        if re.search(r"[*?\[]", p.rstrip("?")) or "*" in p:
            rx = fnmatch.translate(p.lower().strip()).replace("\\Z", "$").replace("\\z", "$").replace("(?s:", "(?s)(?:")
            found = F.transform(_matching(keyed, "^" + rx), lambda e: e["k"])
        else:
            found = F.array(F.lit(source_key(p)))
        hits = F.array_union(hits, found)
    groups = F.transform(hits, lambda k: tidy_values(F.flatten(F.transform(F.filter(keyed, lambda e: e["k"] == k), lambda e: e["values"]))))
    filled = F.filter(groups, lambda g: F.size(g) > 0)
    empty = F.array().cast("array<string>")
    return F.coalesce(F.get(filled, F.lit(0)) if first_only else F.flatten(filled), empty)
