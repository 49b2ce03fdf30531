"""Sinks: tab-separated graph files, N-Triples, files for recommender libraries, JSON reports."""

from __future__ import annotations

import json
import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Vocabularies of the exported graph (fixed values).
RDF_TYPE, RDFS_LABEL = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://www.w3.org/2000/01/rdf-schema#label"
SCHEMA = "http://schema.org/"


def tsv_safe(c: Column) -> Column:
    return F.translate(c, "\t\r\n", "   ")


def write_tsv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """One line per row, tabs and line ends within values made blanks, nulls empty; the folder is replaced."""
    line = F.concat_ws("\t", *[F.coalesce(tsv_safe(F.col(c).cast("string")), F.lit("")) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").option("compression", compression).text(path)


def percent(c: Column) -> Column:
    """Percent-encoding that leaves letters, digits and _ . - ~ alone."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def literal(c: Column) -> Column:
    """A quoted literal with backslash, quote and line ends escaped."""
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), c, F.lit('"'))


def triple(s: Column, p: Column | str, o: Column) -> Column:
    p = F.lit(p) if isinstance(p, str) else p
    return F.concat(F.lit("<"), s, F.lit("> <"), p, F.lit("> "), o, F.lit(" ."))


def ntriples(kg: DataFrame, link: DataFrame, text: DataFrame, image: DataFrame, base: str, taxonomy: DataFrame | None = None, alignments: dict[str, str] | None = None) -> DataFrame:
    """line: type and label of products, descriptions, pictures, edges, one label per entity (relation and value), taxonomy, alignments."""
    iri = lambda *parts: F.concat(F.lit(base), *parts)
    product = iri(F.lit("product/"), percent(F.col("product_id")))
    entity = iri(F.lit("entity/"), percent(F.col("relation")), F.lit("/"), percent(F.col("value")))
    ref = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    line = lambda df, c: df.select(c.alias("line"))
    full = kg.filter("product_id IS NOT NULL AND relation IS NOT NULL AND value IS NOT NULL")
    parts = [
        line(link.filter("product_id IS NOT NULL"), F.explode(F.array(triple(product, RDF_TYPE, F.lit(f"<{SCHEMA}Product>")), triple(product, RDFS_LABEL, literal(F.coalesce("product_name", F.lit(""))))))),
        line(text.filter("product_id IS NOT NULL AND text IS NOT NULL"), triple(product, SCHEMA + "description", literal(F.col("text")))),
        line(image.filter("product_id IS NOT NULL AND url IS NOT NULL"), triple(product, SCHEMA + "image", ref(F.col("url")))),
        line(full, triple(product, iri(F.lit("relation/"), percent(F.col("relation"))), ref(entity))),
        line(full.select("relation", "value").distinct(), triple(entity, RDFS_LABEL, literal(F.col("value")))),
    ]
    if taxonomy is not None:
        node = lambda c: iri(F.lit("type/"), percent(F.col(c)))
        parts.append(line(taxonomy, triple(node("parent"), iri(F.lit("relation/"), percent(F.col("relation"))), ref(node("child")))))
    if alignments:
        spark: SparkSession = kg.sparkSession
        rows = [(f"<{base}relation/{quote(r, safe='')}> <http://www.w3.org/2002/07/owl#equivalentProperty> <{o}> .",) for r, o in sorted(alignments.items())]
        parts.append(spark.createDataFrame(rows, "line string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recommender_files(inter: DataFrame, kg: DataFrame, path: str, one_file: bool = False) -> None:
    """Folders inter and its splits, kg and link with typed headers, tab-separated; triples of the items that have interactions.

    Interactions are sorted by user, time and item; the parts of a folder follow each other in this order, each with a header. one_file makes
    one part of each, in one task, for tables that fit a single machine.
    """
    typed = {"user": "user_id:token", "item": "item_id:token", "rating": "rating:float", "ts": "timestamp:float"}
    write = lambda df, name: (df.coalesce(1) if one_file else df).write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{path}/{name}")
    rows = inter.orderBy("user", "ts", "item").select(*[F.col(c).alias(t) for c, t in typed.items()], *(["split"] if "split" in inter.columns else []))
    write(rows.drop("split"), "inter")
    for s in ("train", "valid", "test") if "split" in inter.columns else ():
        write(rows.filter(F.col("split") == s).drop("split"), s)
    items = inter.select(F.col("item").alias("product_id")).distinct()
    write(kg.join(items, "product_id", "left_semi").select(F.col("product_id").alias("head_id:token"), F.col("relation").alias("relation_id:token"), F.col("value").alias("tail_id:token")), "kg")
    write(items.select(F.col("product_id").alias("item_id:token"), F.col("product_id").alias("entity_id:token")), "link")


#: Rows of a report, at most.
REPORT_ROWS = 100_000


def write_report(df: DataFrame, path: str) -> None:
    """A small table (a row per relation or category) as a JSON file beside the data. A table of more than REPORT_ROWS rows is no report: ValueError."""
    rows = [r.asDict(recursive=True) for r in df.take(REPORT_ROWS + 1)]
    if len(rows) > REPORT_ROWS:
        raise ValueError(f"a report of more than {REPORT_ROWS} rows; write the table with Spark")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=1, default=str)


def latex_half_matrix(pairs: DataFrame, value: str, categories: list[str], form: str = "{:.1f}", scale: float = 1.0) -> str:
    """The upper triangle of a table of pairs of categories as the rows of a LaTeX table; pairs without a value get a dash."""
    known = {(r.category_a, r.category_b): r[value] for r in pairs.select("category_a", "category_b", value).filter(F.col("category_a").isin(categories) & F.col("category_b").isin(categories)).collect()}
    lines = []
    for i, a in enumerate(categories[:-1]):
        cells = ["" if j <= i else "--" if (v := known.get(tuple(sorted((a, b))))) is None else form.format(v * scale) for j, b in enumerate(categories) if j]
        lines.append(" & ".join([a.replace("_", r"\_").replace("&", r"\&"), *cells]) + r" \\")
    return "\n".join(lines)


def latex_macros(values: dict[str, object]) -> str:
    """One ``newcommand`` per value; whole numbers get thousands separators, other numbers one decimal, signs of LaTeX are escaped."""

    def written(v: object) -> str:
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return re.sub(r"([&%$#_{}])", r"\\\1", str(v))
        return f"{v:,}".replace(",", "{,}") if isinstance(v, int) else f"{v:.1f}"

    return "\n".join(f"\\newcommand{{\\{name}}}{{{written(v)}}}" for name, v in values.items())


def external_subset(targets: DataFrame, current: DataFrame, legacy: DataFrame) -> DataFrame:
    """Records of the wanted ids (product_id): from the current source, what is missing there from the legacy one, the first record of each (by row)."""
    wanted = targets.select("product_id").distinct()
    now = current.join(wanted, "product_id", "left_semi")
    old = legacy.join(wanted, "product_id", "left_semi").join(now.select("product_id").distinct(), "product_id", "left_anti")
    both = now.withColumn("_source", F.lit(0)).unionByName(old.withColumn("_source", F.lit(1)), allowMissingColumns=True)
    first = both.groupBy("product_id").agg(F.min(F.struct("_source", "row")).alias("_first"))
    return both.join(first, "product_id").filter((F.col("_source") == F.col("_first._source")) & (F.col("row") == F.col("_first.row"))).drop("_source", "_first")
