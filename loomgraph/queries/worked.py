"""Queries of operators whose rules SQL can't state shortly: worked examples spread over all rows of a table, with the results written
out in the SQL; sources and sinks, written to the shared folder and read back; learned vocabularies and plurals."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.common import new_path, norm_id, subject_id, table
from loomgraph.operators import audit, graph, interactions, learn, profile
from loomgraph.operators.values import Env, apply, step
from loomgraph.plans.build import build, report
from loomgraph.plans.config import Config
from loomgraph.sources import archives, exports, records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ID = r"upper(regexp_replace({0}, '[\s\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]', '', 'g'))".format
PID = ID("list_extract(string_split(subject, '##'), -1)")


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return f"[{', '.join(map(_text, values))}]::VARCHAR[]"


def worked(name: str, op: str, params: dict[str, Any], cases: list[tuple[str | list[str], list[str]]]) -> None:
    """A query of a value operator: row n of kg_triples has the values of case n modulo their number, and the results written beside them."""
    given = [[v] if isinstance(v, str) else v for v, _ in cases]

    def run(spark: SparkSession, d: str) -> DataFrame:
        case = F.get(F.array(*[F.array(*[F.lit(x) for x in vs]) for vs in given]), F.pmod("row_id", F.lit(len(given))).cast("int"))
        rows = table(spark, d, "kg_triples").select("row_id", case.alias("vals"))
        return rows.withColumn("vals", apply(F.col("vals"), op, params, Env()).values).select("row_id", F.explode("vals").alias("value"))

    QUERIES[name] = run
    results = ", ".join(_list(out) for _, out in cases)
    ORACLE[name] = f"SELECT row_id, unnest(list_extract([{results}], 1 + CAST(row_id % {len(cases)} AS INTEGER))) AS value FROM kg_triples"


worked("op_fix_encoding", "fix_encoding", {}, [
    ("cafÃ© noir", ["café noir"]), ("MÃ¼ller", ["MÃ1⁄4ller"]), ("Ã©tÃ©", ["été"]), ("ﬁne", ["fine"]), ("plain", ["plain"]), ("Crème", ["Crème"]), ("ＡＢＣ", ["ABC"]), ("São Paulo", ["São Paulo"]),
])
worked("op_person_name", "person_name", {}, [
    ("o'connor, x", ["O'Connor, X."]), ("john MCDONALD jr", ["John McDonald Jr."]), ("j.k. rowling", ["J.K. Rowling"]), ("ludwig van beethoven", ["Ludwig van Beethoven"]), ("cher", []),
    ("anne-marie de la tour", ["Anne-Marie de la Tour"]), ("jean macdonald", ["Jean MacDonald"]), ("fiona mackie", ["Fiona Mackie"]), ("", []), ("JOHN SMITH III", ["John Smith III"]), ("-- ??", []),
])
worked("op_normalize_dimensions", "normalize_dimensions", {}, [
    ("48cm*48cm", ["48 x 48 cm"]), ("48x48", ["48 x 48 cm"]), ("30x40cm/12x16inch", ["30 x 40 cm"]), ("small 4x1.5 inch", ["10.2 x 3.8 cm"]), ("12-x-12-inch", ["30.5 x 30.5 cm"]),
    ("7 5 inch", ["19.1 cm"]), ("146 x 38 month", ["146 x 38 month"]), ("1 x 2 x 3 x 4 cm", ["1 x 2 x 3 x 4 cm"]), ("Small", ["Small"]), ("2x3 m", ["200 x 300 cm"]), ("16 x 1 x 1 inches; 1.76 Ounces", ["40.6 x 2.5 x 2.5 cm"]),
    ("10 x 20 mm (approx.)", ["1 x 2 cm"]), ("3' deep", ["3' deep"]), ("0 x 4 cm", ["0 x 4 cm"]),
])
worked("op_normalize_dimensions_strict", "normalize_dimensions", {"drop_unparsed": True, "unit": "mm", "decimals": 0}, [("Small", []), ("2 x 3 cm", ["20 x 30 mm"]), ("1 by 2 by 3 in", ["25 x 51 x 76 mm"])])
worked("op_extract_sizes", "extract_sizes", {}, [
    ("Women's S M XL 10 inch 25.4 cm", ["S", "M", "XL", "25.4 cm"]), ("x-large tee", ["XL"]), ("s m l", []), ("12 in wide", ["30.5 cm"]), ("One Size", ["One Size"]), ("0 cm", []), ("12345 mm", []), ("1.234 cm", []),
    ("Plus size 3XL, 2x", ["Plus Size", "XXXL", "XXL"]), ("mug", []),
])
worked("op_parse_age", "parse_age_bin", {}, [
    ("0-6 months", ["0 months"]), ("6 Months - 3 Years", ["6 months"]), ("3+", ["36 months"]), ("Toddler", ["12 months"]), ("96.00", ["96 months"]), ("Teen and Adults", ["168 months"]), ("x", []),
    ("8 weeks and up", ["2 months"]), ("preschool", ["36 months"]),
])
worked("op_map_tight", "map", {"table": {"skyblue": "Sky Blue", "off white": "White"}, "tight": True, "strict": True}, [("Sky Blue", ["Sky Blue"]), ("sky-blue", ["Sky Blue"]), ("offwhite", []), ("Off-White", ["White"]), ("red", [])])
worked("op_regex_map_whole", "regex_map", {"rules": [["^usb", "USB"], ["wi-?fi", "Wi-Fi"]]}, [("USB-C cable", ["USB"]), ("has WiFi", ["Wi-Fi"]), ("wired", ["wired"])])
worked("op_category_leaf", "category_path", {"leaf_only": True}, [(["Root", "A", "B"], ["B"]), (["Root"], ["Root"]), (["A", "C"], ["C"])])
worked("op_strip_roles_several", "strip_roles", {}, [("Ann Lee (Author, Editor)", ["Ann Lee"]), ("Bo Ray (Director and Producer)", ["Bo Ray"]), ("Cy Fox (Remastered)", ["Cy Fox (Remastered)"])])


# what learned operators know

_WORDS = "w AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS value FROM kg_text WHERE text IS NOT NULL), c AS (SELECT value, count(*) AS n FROM w GROUP BY value)"


@query(
    f"WITH RECURSIVE {_WORDS}, forms AS (SELECT lower(value) AS form, min(value) AS v, arg_min(n, value) AS n FROM c GROUP BY 1), "
    "cand AS (SELECT value, n, 0 AS r, left(lower(value), length(value) - 3) || 'y' AS form FROM c WHERE lower(value) LIKE '%ies' AND length(value) > 5 "
    "UNION ALL SELECT value, n, 1, left(lower(value), length(value) - 2) FROM c WHERE lower(value) LIKE '%es' AND length(value) > 4 "
    "UNION ALL SELECT value, n, 2, left(lower(value), length(value) - 1) FROM c WHERE lower(value) LIKE '%s' AND lower(value) NOT LIKE '%ss' AND length(value) > 3), "
    "pick AS (SELECT cand.value, cand.n, arg_min(forms.v, r) AS v, arg_min(forms.n, r) AS vn FROM cand JOIN forms USING (form) WHERE form NOT IN ('arm', 'brief', 'custom', 'glass', 'good', 'new', 'short', 'spectacle', 'tight', 'work') AND forms.v <> cand.value GROUP BY ALL), "
    "e AS (SELECT value AS plural, CASE WHEN (n, -length(value), value) < (vn, -length(v), v) THEN value ELSE v END AS value, CASE WHEN (n, -length(value), value) < (vn, -length(v), v) THEN v ELSE value END AS target FROM pick), "
    "m AS (SELECT value, arg_max(target, plural) AS target FROM e GROUP BY value), "
    "far AS (SELECT value, target, 1 AS steps FROM m UNION ALL SELECT far.value, m.target, steps + 1 FROM far JOIN m ON m.value = far.target) SELECT value, arg_max(target, steps) AS target FROM far GROUP BY value"
)
def learn_fold_plural(spark, d):
    words = table(spark, d, "kg_text").filter("text IS NOT NULL").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("value"))
    return learn.plural_map(learn.counts(words, []), [], 1)


@query(
    "WITH RECURSIVE c AS (SELECT value, count(*) AS n, min(row_id) AS f FROM kg_triples WHERE relation = 'hasBrand' AND value IS NOT NULL GROUP BY value HAVING count(*) >= 5 AND length(value) <= 40), "
    "v AS (SELECT array_to_string(regexp_extract_all(lower(value), '[a-z0-9]+'), ' ') AS term, value, f FROM c), one AS (SELECT term, arg_min(value, (f, value)) AS value FROM v WHERE contains(term, ' ') GROUP BY term), "
    "fm AS (SELECT term, min(value) AS value, len(string_split(term, ' ')) AS n FROM (SELECT term, value FROM one UNION ALL SELECT replace(term, ' ', ''), value FROM one) GROUP BY term), "
    "t AS (SELECT row_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM kg_text WHERE text IS NOT NULL), x AS (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM t), "
    "runs AS (SELECT row_id, i, l.n, array_to_string(w[i:i + l.n - 1], ' ') AS term FROM x CROSS JOIN (SELECT DISTINCT n FROM fm) l WHERE i + l.n - 1 <= len(w)), "
    "hits AS (SELECT row_id, i, max(fm.n) AS n, arg_max(value, fm.n) AS value FROM runs JOIN fm USING (term) GROUP BY row_id, i), "
    "walk AS (SELECT DISTINCT row_id, CAST(1 AS BIGINT) AS free, CAST(NULL AS VARCHAR) AS value, CAST(0 AS BIGINT) AS spot FROM hits UNION ALL "
    "SELECT row_id, free, value, spot FROM (SELECT h.row_id, CAST(h.i + h.n AS BIGINT) AS free, h.value, CAST(h.i AS BIGINT) AS spot, row_number() OVER (PARTITION BY h.row_id ORDER BY h.i) AS r FROM walk JOIN hits h ON h.row_id = walk.row_id AND h.i >= walk.free) WHERE r = 1), "
    "firsts AS (SELECT row_id, value, min(spot) AS spot FROM walk WHERE value IS NOT NULL GROUP BY row_id, value), "
    "ranked AS (SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY spot) - 1 AS INTEGER) AS pos, value FROM firsts) SELECT * FROM ranked WHERE pos < 2"
)
def op_match_learned(spark, d):
    """Names of makers that occur five times, sought in the texts."""
    names = learn.counts(table(spark, d, "kg_triples").filter("relation = 'hasBrand'"), [], order="row_id")
    texts = table(spark, d, "kg_text").filter("text IS NOT NULL").select("row_id", "text")
    return learn.find_vocabulary(texts, [], learn.vocabulary(names, [], 5, 40), ["row_id"])


TYPES = {"kettle": "Kettle", "bag": "Bag", "lamp": "Lamp", "mat": "Mat"}
SUBTYPES = {"Kettle": {"gooseneck": "Gooseneck", "drip": "Drip"}, "Bag": {"dry": "Dry Bag", "sling": "Sling Bag"}, "Lamp": {"desk": "Desk Lamp"}, "Mat": {"yoga": "Yoga Mat"}}


@query(
    "WITH ty(word, type) AS (VALUES ('kettle', 'Kettle'), ('bag', 'Bag'), ('lamp', 'Lamp'), ('mat', 'Mat')), "
    "st(type, word, label) AS (VALUES ('Kettle', 'gooseneck', 'Gooseneck'), ('Kettle', 'drip', 'Drip'), ('Bag', 'dry', 'Dry Bag'), ('Bag', 'sling', 'Sling Bag'), ('Lamp', 'desk', 'Desk Lamp'), ('Mat', 'yoga', 'Yoga Mat')), "
    "t AS (SELECT row_number() OVER () AS id, product_id, list_transform(regexp_extract_all(product_name, '[A-Za-z0-9]+'), lambda w: lower(w)) AS w FROM kg_link WHERE product_name IS NOT NULL), "
    "x AS (SELECT id, product_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t), "
    "dom AS (SELECT id, arg_max(type, n * 1000 + last) AS type FROM (SELECT id, type, count(*) AS n, max(i) AS last FROM x JOIN ty USING (word) GROUP BY id, type) GROUP BY id), "
    "s AS (SELECT id, product_id, label, min(i) AS i FROM x JOIN dom USING (id) JOIN st ON st.type = dom.type AND st.word = x.word GROUP BY ALL) "
    "SELECT product_id, label AS value FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY i) <= 2"
)
def op_match_subtype(spark, d):
    names = table(spark, d, "kg_link").filter("product_name IS NOT NULL").select("product_id", F.array("product_name").alias("vals"))
    got = apply(F.col("vals"), "match_subtype", {"types": TYPES, "subtypes": SUBTYPES}, Env())
    return names.select("product_id", got.values.alias("v")).select("product_id", F.explode("v").alias("value"))


# the build

PLAIN = """
defaults: {id_field: pid, min_relations: 3, subject: {fields: [title], disambiguate: always}}
categories:
  X:
    relations:
      hasCountryOfOrigin: {sources: [details/hasCountryOfOrigin], pre_ops: [], ops: [upper]}
      hasMaterial: {sources: [details/hasMaterial], pre_ops: [], ops: [lower]}
      hasBrand: {sources: [details/hasBrand], pre_ops: [], ops: [{op: max_values, n: 1}]}
      hasGenre: {sources: [details/hasCategory], pre_ops: [], ops: [{op: split_smart, mode: always}]}
      hasOrigin: {sources: [details/hasCountryOfOrigin], pre_ops: [], ops: [{op: keep_matching, patterns: [land]}], fallback_for: hasNothing}
"""
_C = r"trim(regexp_replace({0}, '[\s\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{00}}-\x{{08}}\x{{0b}}\x{{0c}}\x{{0e}}-\x{{1f}}\x{{7f}}]+', ' ', 'g'))".format
_K = r"trim(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))".format
_BUILT = (
    f"t AS (SELECT {PID} AS pid, relation, value, row_id FROM kg_triples WHERE contains(subject, '##') AND relation IS NOT NULL AND value IS NOT NULL), "
    f"det AS (SELECT pid, relation, {_C('arg_max(value, row_id)')} AS v FROM t GROUP BY pid, relation), titles AS (SELECT {ID('product_id')} AS pid, min(product_name) AS title FROM kg_link GROUP BY 1), "
    "known AS (SELECT pid FROM titles WHERE trim(title) <> ''), "
    f"vals AS (SELECT pid, 'hasCountryOfOrigin' AS relation, upper(v) AS value, 1 AS pos FROM det WHERE relation = 'hasCountryOfOrigin' UNION ALL SELECT pid, 'hasMaterial', lower(v), 1 FROM det WHERE relation = 'hasMaterial' "
    "UNION ALL SELECT pid, 'hasBrand', v, 1 FROM det WHERE relation = 'hasBrand' UNION ALL SELECT pid, 'hasNothing', v, 1 FROM det WHERE relation = 'hasCountryOfOrigin' AND regexp_matches(lower(v), 'land') "
    f"UNION ALL SELECT pid, 'hasGenre', {_C('x')}, i FROM (SELECT pid, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM (SELECT pid, list_filter(regexp_split_to_array(v, ' & | and | [+] |[/,;|]'), lambda x: length({_C('x')}) >= 3) AS p FROM det WHERE relation = 'hasCategory'))), "
    f"ok AS (SELECT * FROM vals WHERE value <> ''), one AS (SELECT pid, relation, value FROM ok QUALIFY row_number() OVER (PARTITION BY pid, relation, {_K('value')} ORDER BY pos) = 1), "
    "kg AS (SELECT pid, relation, value FROM one WHERE pid IN (SELECT pid FROM known) AND pid IN (SELECT pid FROM one GROUP BY pid HAVING count(*) >= 3))"
)


def _built(spark: SparkSession, d: str):
    rows = table(spark, d, "kg_triples").select(subject_id("subject").alias("pid"), "relation", "value", "row_id").filter("pid IS NOT NULL AND relation IS NOT NULL AND value IS NOT NULL")
    details = rows.groupBy("pid", "relation").agg(F.max_by("value", "row_id").alias("value"), F.min("row_id").alias("ord"))
    made = details.groupBy("pid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("relation", "value")))).alias("details"), F.min("ord").alias("ord"))  # one value per relation
    names = table(spark, d, "kg_link").groupBy(norm_id("product_id").alias("pid")).agg(F.min("product_name").alias("title"))
    products = made.join(names, "pid").select("pid", "ord", records.flat(F.to_json(F.struct("title", "details"))).alias("flat"))
    return build(products, Config.parse(PLAIN).plan("X"))


@query(f"WITH {_BUILT} SELECT * FROM kg")
def kg_build_plain(spark, d):
    """The engine with operators that SQL knows: sources, pipelines, first values of a key, a stand-in relation, products of three relations, titles."""
    return _built(spark, d).kg.select("pid", "relation", "value")


@query(f"WITH {_BUILT} SELECT relation, count(*) AS triples, count(DISTINCT value) AS distinct_values, count(DISTINCT {_K('value')}) AS distinct_keys FROM kg GROUP BY relation")
def build_report(spark, d):
    return report(_built(spark, d))


@query(f"WITH {_BUILT} SELECT pid, count(*) AS n FROM kg GROUP BY pid")
def min_relations(spark, d):
    """Triples of the products that the engine keeps: those of three or more."""
    return _built(spark, d).kg.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {_BUILT}, n AS (SELECT pid, trim({_C('title')}, ' -|·•,;') AS name FROM titles WHERE pid IN (SELECT pid FROM t)), h AS (SELECT name, count(*) AS n_homonyms FROM n WHERE name <> '' GROUP BY name) "
    "SELECT pid AS product_id, name || ' ##' || pid AS subject, n_homonyms, name AS product_name FROM n JOIN h USING (name) WHERE pid IN (SELECT pid FROM kg)"
)
def subject_build(spark, d):
    """Subjects and the numbers of products that share their names."""
    return _built(spark, d).link.select("product_id", "subject", "n_homonyms", "product_name")


@query("SELECT variant, least(20, count(*)) AS n, count(*) >= 20 AS is_full, true AS all_members FROM kg_image WHERE variant IS NOT NULL GROUP BY variant")
def stratified_sample(spark, d):
    """Twenty rows of each variant: how many were drawn, and that all are rows of their variant, each drawn once."""
    rows = table(spark, d, "kg_image").filter("variant IS NOT NULL").select("variant", "row_id")
    drawn = graph.stratified_sample(rows, "variant", "row_id", 20)
    member = drawn.join(rows.withColumn("known", F.lit(True)), ["variant", "row_id"], "left")
    return member.groupBy("variant").agg(
        F.count_distinct("row_id").alias("n"), (F.count(F.lit(1)) == 20).alias("is_full"), (F.bool_and(F.coalesce("known", F.lit(False))) & (F.count_distinct("row_id") == F.count(F.lit(1)))).alias("all_members")
    )


# sources and sinks: written, read back


def _as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


@query("SELECT 'Books' AS category, product_id, n_homonyms, product_name FROM kg_link")
def source_json_lines(spark, d):
    """kg_link as compressed JSON lines between other lines; category from the name of the folder's files given as known."""
    path = new_path(spark, "meta_Books.jsonl")
    lines = _as_json(table(spark, d, "kg_link").select("product_id", "n_homonyms", "product_name"))
    lines.unionByName(spark.range(20).select(F.lit("no record").alias("value"))).write.option("compression", "gzip").text(path)
    got = records.read_json_lines(spark, [path if "://" in path else f"file://{path}"], partitions=4).select(F.from_json("json", "product_id string, n_homonyms bigint, product_name string").alias("r"))
    return got.select(F.lit("Books").alias("category"), "r.*")


@query("SELECT relation, term, canonical_id FROM rule_terms")
def source_json_array(spark, d):
    path = new_path(spark, "array")
    rows = _as_json(table(spark, d, "rule_terms").select("relation", "term", "canonical_id"))
    whole = rows.agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value"))  # a reference list of fixed size, as one document
    whole.coalesce(1).write.text(path)
    return records.read_json_array(spark, path).select(F.from_json("json", "relation string, term string, canonical_id bigint").alias("r")).select("r.*")


@query("SELECT 'list.zip/a.jsonl' AS member, canonical_id, relation FROM canon_values UNION ALL SELECT 'list.zip/inner.zip/b.jsonl', canonical_id, relation FROM canon_values")
def source_zip(spark, d):
    """Lines of an archive and of an archive within it."""
    lines = "\n".join(json.dumps(r.asDict(), ensure_ascii=False) for r in table(spark, d, "canon_values").select("canonical_id", "relation").collect())  # a reference list of fixed size
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("b.jsonl", lines)
        z.writestr("b.txt", "not read")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("a.jsonl", lines)
        z.writestr("inner.zip", inner.getvalue())
    path = f"{new_path(spark, 'zip')}/list.zip"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(outer.getvalue()))
    out.close()
    got = archives.read_zip_lines(spark, path, ".jsonl")
    return got.select("member", F.from_json("value", "canonical_id bigint, relation string").alias("r")).select("member", "r.*")


def _tabled(spark: SparkSession, d: str, sep: str, suffix: str) -> DataFrame:
    path = new_path(spark, f"table{suffix}")
    t = table(spark, d, "relation_types").select(F.col("relation").alias("name"), F.col("column_name").alias("details/column"), F.col("unit").alias("details/unit"))
    t.coalesce(1).write.csv(path, header=True, sep=sep)
    got = records.read_table(spark, path, sep).select(F.from_json("json", "name string, details map<string,string>").alias("r"))
    return got.select("r.name", F.try_element_at("r.details", F.lit("column")).alias("column_name"), F.try_element_at("r.details", F.lit("unit")).alias("unit"))


_TABLED = "SELECT relation AS name, column_name, nullif(trim(unit), '') AS unit FROM relation_types"


@query(_TABLED)
def source_csv(spark, d):
    return _tabled(spark, d, ",", ".csv")


@query(_TABLED)
def source_tsv(spark, d):
    return _tabled(spark, d, "\t", ".tsv")


@query("SELECT row_id, product_id FROM kg_text WHERE product_id IS NOT NULL")
def source_literals(spark, d):
    """Lines of Python dictionaries among others that don't match the pattern."""
    path = new_path(spark, "literals")
    rows = table(spark, d, "kg_text").filter("product_id IS NOT NULL").select(F.format_string("{'row_id': %d, 'product_id': '%s', 'more': None}", "row_id", F.replace("product_id", F.lit("'"), F.lit("\\'"))).alias("value"))
    rows.unionByName(spark.range(10).select(F.lit("{'other': 1}").alias("value"))).write.text(path)
    got = records.read_literals(spark, [path if "://" in path else f"file://{path}"], "'row_id'").select(F.from_json("json", "row_id bigint, product_id string").alias("r"))
    return got.select("r.*")


@query("SELECT DISTINCT category AS known, category FROM interactions WHERE category IS NOT NULL UNION ALL SELECT 'Else', 'Else_x'")
def category_inference(spark, d):
    """The category in the name of a file: the longest known one, else what follows meta_."""
    known = [r.category for r in table(spark, d, "interactions").filter("category IS NOT NULL").select("category").distinct().collect()]
    names = spark.createDataFrame([(k, f"/data/meta_{k}.jsonl.gz") for k in sorted(known)] + [("Else", "/data/meta_Else_x.jsonl")], "known string, path string")
    return names.select("known", records.category_of(F.col("path"), known).alias("category"))


@query(r"SELECT concat_ws(chr(9), CAST(row_id AS VARCHAR), coalesce(translate(product_id, chr(9) || chr(10) || chr(13), '   '), ''), coalesce(variant, ''), coalesce(url, '')) AS value FROM kg_image")
def sink_tsv(spark, d):
    path = new_path(spark, "tsv")
    exports.write_tsv(table(spark, d, "kg_image").select("row_id", "product_id", "variant", "url"), path)
    return spark.read.text(path).select("value")


@query("SELECT translate(text, chr(9) || chr(10) || chr(13), '   ') AS text, row_id FROM kg_text")
def tsv_safe(spark, d):
    return table(spark, d, "kg_text").select("row_id", exports.tsv_safe(F.col("text")).alias("text"))


_RATED = f"""i AS (SELECT {ID('"user"')} AS u, {ID('item')} AS p, max(coalesce(rating, 0)) AS rating, max(CASE WHEN ts > 100000000000 THEN ts // 1000 ELSE ts END) AS ts FROM interactions WHERE "user" IS NOT NULL AND item IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)"""


def _exported(spark: SparkSession, d: str, name: str) -> DataFrame:
    path = new_path(spark, "recommender")
    t = table(spark, d, "interactions").filter("user IS NOT NULL AND item IS NOT NULL AND ts IS NOT NULL")
    ts = F.when(F.col("ts") > 100_000_000_000, F.floor(F.col("ts") / 1000)).otherwise(F.col("ts"))
    inter = t.groupBy(norm_id("user").alias("user"), norm_id("item").alias("item")).agg(F.max(F.coalesce("rating", F.lit(0.0))).alias("rating"), F.max(ts).cast("bigint").alias("ts"))
    kg = table(spark, d, "kg_triples").select(subject_id("subject").alias("product_id"), "relation", F.regexp_replace("value", r"[\t\r\n\"\\]", " ").alias("value")).filter("product_id IS NOT NULL AND value IS NOT NULL AND trim(value) <> ''")
    exports.recommender_files(inter, kg, path)
    return spark.read.csv(f"{path}/{name}", header=True, sep="\t")


@query(f"WITH {_RATED} SELECT u AS user_id, p AS item_id, CAST(rating AS DOUBLE) AS rating, CAST(ts AS DOUBLE) AS timestamp FROM i")
def sink_interactions(spark, d):
    """Interactions with typed headers, read back."""
    got = _exported(spark, d, "inter")
    return got.select(F.col("user_id:token").alias("user_id"), F.col("item_id:token").alias("item_id"), F.col("rating:float").cast("double").alias("rating"), F.col("timestamp:float").cast("double").alias("timestamp"))


@query(f"WITH {_RATED}, k AS (SELECT {PID} AS head, relation, regexp_replace(value, '[\\t\\r\\n\"\\\\]', ' ', 'g') AS v FROM kg_triples WHERE contains(subject, '##') AND value IS NOT NULL) SELECT relation, count(*) AS n, count(DISTINCT head) AS heads FROM k WHERE trim(v) <> '' AND head IN (SELECT p FROM i) GROUP BY relation")
def graph_restriction(spark, d):
    """The triples of items that have interactions, as exported."""
    got = _exported(spark, d, "kg")
    return got.groupBy(F.col("relation_id:token").alias("relation")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("head_id:token").alias("heads"))


@query(r"SELECT product_id, regexp_replace(product_name, '^[#\s]+', '') AS name FROM kg_link")
def subject_cleaning(spark, d):
    return table(spark, d, "kg_link").select("product_id", graph.plain_subject(F.col("product_name")).alias("name"))


@query(
    f"WITH g AS (SELECT DISTINCT {ID('product_id')} AS product_id FROM kg_link WHERE product_id IS NOT NULL), c AS (SELECT {ID('product_id')} AS product_id, row_id, 'now' AS origin FROM kg_text), "
    f"o AS (SELECT {ID('product_id')} AS product_id, doc_id AS row_id, 'old' AS origin FROM documents), a AS (SELECT * FROM c UNION ALL SELECT * FROM o WHERE product_id NOT IN (SELECT product_id FROM c WHERE product_id IS NOT NULL)) "
    "SELECT product_id, arg_min(origin, row_id) AS origin, min(row_id) AS row FROM a WHERE product_id IN (SELECT product_id FROM g) GROUP BY product_id"
)
def external_subset(spark, d):
    """Texts of the products of kg_link from kg_text; of products without one, the first document."""
    wanted = table(spark, d, "kg_link").select(norm_id("product_id").alias("product_id")).filter("product_id IS NOT NULL")
    now = table(spark, d, "kg_text").select(norm_id("product_id").alias("product_id"), F.col("row_id").alias("row"), F.lit("now").alias("origin"))
    old = table(spark, d, "documents").select(norm_id("product_id").alias("product_id"), F.col("doc_id").alias("row"), F.lit("old").alias("origin"))
    return exports.external_subset(wanted, now, old).select("product_id", "origin", "row")


# figures about graphs and interactions

_OVER = "v AS (SELECT DISTINCT category, item AS object FROM interactions WHERE category IS NOT NULL AND item IS NOT NULL), s AS (SELECT category, count(*) AS n FROM v GROUP BY category), j AS (SELECT x.category AS category_a, y.category AS category_b, count(*) AS shared, count(*) / (any_value(sa.n) + any_value(sb.n) - count(*)) AS jaccard FROM v x JOIN v y ON x.object = y.object AND x.category < y.category JOIN s sa ON sa.category = x.category JOIN s sb ON sb.category = y.category GROUP BY ALL)"


@query(f"WITH {_OVER} SELECT count(*) AS pairs, count(*) FILTER (jaccard >= 0.01) AS pairs_from, arg_max(category_a, (jaccard, shared, category_a, category_b)) AS category_a, arg_max(category_b, (jaccard, shared, category_a, category_b)) AS category_b, round(max(jaccard), 6) AS jaccard, arg_max(shared, (jaccard, shared, category_a, category_b)) AS shared FROM j")
def overlap_summary(spark, d):
    """The pair of categories that share most items, and how many pairs share one in a hundred."""
    values = table(spark, d, "interactions").select("category", F.col("item").alias("object"))
    return interactions.overlap_summary(interactions.entity_overlap(values)).withColumn("jaccard", F.round("jaccard", 6))


@query(
    f"WITH i AS (SELECT {ID('item')} AS p FROM interactions WHERE item IS NOT NULL), k AS (SELECT {PID} AS p, relation FROM kg_triples WHERE contains(subject, '##')), n AS (SELECT count(DISTINCT p) AS items, count(*) AS c FROM i), "
    "o AS (SELECT count(*) AS t, count(DISTINCT relation) AS r FROM k WHERE p IN (SELECT p FROM i)) SELECT items, round(c / greatest(items, 1), 2) AS interactions_per_item, t AS kg_triples, r AS kg_relations, round(t / greatest(items, 1), 2) AS kg_triples_per_item FROM n, o"
)
def ratios_per_item(spark, d):
    inter = table(spark, d, "interactions").filter("item IS NOT NULL").select(norm_id("item").alias("item"))
    kg = table(spark, d, "kg_triples").select(subject_id("subject").alias("product_id"), "relation").filter("product_id IS NOT NULL")
    return interactions.per_item(inter, kg)


@query('SELECT category, "user", count(*) AS n FROM interactions WHERE category IS NOT NULL AND "user" IS NOT NULL GROUP BY ALL')
def users_by_signature(spark, d):
    """Users of each category, counted once per signature of its table; the second call reads what the first has written."""
    t = table(spark, d, "interactions").filter("category IS NOT NULL")
    names = [r.category for r in t.select("category").distinct().collect()]
    folder = new_path(spark, "users")
    given = {c: ("v1", t.filter(F.col("category") == c)) for c in names}
    interactions.users_per_category(spark, given, folder)
    return interactions.users_per_category(spark, {c: ("v1", x.limit(0)) for c, (_, x) in given.items()}, folder)


@query(
    f"WITH l AS (SELECT DISTINCT {ID('product_id')} AS p FROM kg_link WHERE product_id IS NOT NULL), t AS (SELECT DISTINCT {ID('product_id')} AS p FROM kg_text WHERE product_id IS NOT NULL), i AS (SELECT DISTINCT {ID('product_id')} AS p FROM kg_image WHERE product_id IS NOT NULL), k AS (SELECT DISTINCT {PID} AS p FROM kg_triples WHERE contains(subject, '##')), "
    "f AS (SELECT p IN (SELECT p FROM t) AS t, p IN (SELECT p FROM i) AS i, p IN (SELECT p FROM k) AS k FROM l) SELECT count(*) AS before, count(*) FILTER (t) AS with_text, count(*) FILTER (i) AS with_image, count(*) FILTER (t AND i) AS after, count(*) FILTER (t AND i AND k) AS after_with_triples, round(count(*) FILTER (t AND i) / greatest(count(*), 1), 4) AS retention FROM f"
)
def retention(spark, d):
    link, text, image = (table(spark, d, name).withColumn("product_id", norm_id("product_id")) for name in ("kg_link", "kg_text", "kg_image"))
    return graph.retention(table(spark, d, "kg_triples").select(subject_id("subject").alias("product_id")), link, text, image)


@query(
    "WITH a AS (SELECT relation AS key, value FROM kg_triples WHERE relation IS NOT NULL AND value IS NOT NULL), p AS (SELECT key, value, list_filter(list_transform(regexp_split_to_array(value, '[,;|]'), lambda x: trim(x)), lambda x: length(x) >= 2) AS f FROM a), "
    "b AS (SELECT key, 'raw' AS kind, value FROM a UNION ALL SELECT key, 'atomic', unnest(CASE WHEN len(f) > 1 THEN f ELSE [value] END) FROM p), c AS (SELECT key, kind, value, count(*) AS n FROM b GROUP BY ALL) "
    "SELECT key, kind, CAST(row_number() OVER (PARTITION BY key, kind ORDER BY n DESC, value) AS INTEGER) AS rank, value, n FROM c QUALIFY rank <= 8"
)
def discover_examples(spark, d):
    return profile.key_examples(table(spark, d, "kg_triples").select(F.col("relation").alias("key"), "value"))


@query("SELECT row_id, text FROM kg_text ORDER BY row_id LIMIT 100")
def record_limit(spark, d):
    """The first hundred records, for a trial run: the limit is the feature."""
    return records.first_records(table(spark, d, "kg_text").select("row_id", "text"), 100, "row_id")


@query("SELECT least(100, count(*)) AS n, true AS distinct_rows FROM kg_text")
def record_sample(spark, d):
    """A hundred records by hash: how many, and that each is drawn once. The sample is the feature."""
    got = records.sampled(table(spark, d, "kg_text").select("row_id"), 100, "row_id")
    return got.agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("row_id") == F.count(F.lit(1))).alias("distinct_rows"))


@query(
    "WITH l AS (SELECT CASE row_id % 4 WHEN 0 THEN '# note' WHEN 1 THEN concat_ws(chr(9), 's', coalesce(relation, ''), 'o') WHEN 2 THEN 'broken ' || CAST(row_id AS VARCHAR) ELSE concat_ws(chr(9), CAST(row_id AS VARCHAR), 'r', 'o') END AS value, row_id FROM kg_triples) "
    "SELECT count(*) AS lines, count(*) FILTER (row_id % 4 = 0) AS comments, count(*) FILTER (row_id % 4 = 2) AS malformed, count(*) FILTER (row_id % 4 = 1) - count(DISTINCT CASE WHEN row_id % 4 = 1 THEN value END) AS duplicates FROM l"
)
def audit_read(spark, d):
    """Lines of a triple file that are comments, malformed or repeated."""
    path = new_path(spark, "kg-lines")
    n = F.pmod("row_id", F.lit(4))
    line = F.when(n == 0, "# note").when(n == 1, F.concat_ws("\t", F.lit("s"), F.coalesce("relation", F.lit("")), F.lit("o"))).when(n == 2, F.concat(F.lit("broken "), F.col("row_id").cast("string"))).otherwise(F.concat_ws("\t", F.col("row_id").cast("string"), F.lit("r"), F.lit("o")))
    table(spark, d, "kg_triples").select(line.alias("value")).write.text(path)
    return audit.read_counts(spark.read.text(path))


# configurations

_FAMILY = """
defaults: {pre_ops: [collapse_ws], global_relations: {hasBrand: {sources: [brand], ops: [title_case]}}}
categories:
  _base: {relations: {hasColor: {sources: [color], ops: [lower]}, hasSize: {sources: [size]}}}
  Books: {inherit: _base, relations: {hasColor: {sources: [cover color], ops: [upper, lower]}, hasSize: null}}
  Films: {inherit: Books, relations: {hasRuntime: {sources: [runtime, length], pre_ops: [], ops: [{op: parse_runtime_bin}]}}}
"""
_BROKEN = """
categories:
  A: {relations: {hasX: {ops: [lower]}, hasY: {sources: [y], ops: [no_such_op, {op: map, rules_ref: colors.missing}]}}}
  B: {inherit: C}
  C: {inherit: B}
"""


@query(
    "SELECT * FROM (VALUES ('Books', 'hasBrand', 'brand', 'collapse_ws,title_case'), ('Books', 'hasColor', 'cover color', 'collapse_ws,upper,lower'), "
    "('Films', 'hasBrand', 'brand', 'collapse_ws,title_case'), ('Films', 'hasColor', 'cover color', 'collapse_ws,upper,lower'), ('Films', 'hasRuntime', 'runtime,length', 'parse_runtime_bin')) v(category, relation, sources, pipeline)"
)
def config_inheritance(spark, d):
    """Relations of categories that inherit, override and take away."""
    config = Config.parse(_FAMILY)
    rows = [(c, r.name, ",".join(r.sources), ",".join(step(o)[0] for o in r.pipeline)) for c in config.categories for r in config.plan(c).relations]
    return spark.createDataFrame(rows, "category string, relation string, sources string, pipeline string")


@query("SELECT * FROM (VALUES ('A.hasX', 'no sources'), ('A.hasY', 'unknown operation'), ('A.hasY', 'leads nowhere'), ('B', 'circle'), ('C', 'circle'), ('strict', 'repeated key')) v(place, problem)")
def config_validation(spark, d):
    """Problems of a configuration, and a key that is written twice."""
    kinds = ("no sources", "unknown operation", "leads nowhere", "circle")
    rows = [(p.split(":")[0], next(k for k in kinds if k in p)) for p in Config.parse(_BROKEN, {"colors": {}}).validate()]
    try:
        Config.parse("categories: {A: {relations: {}}, A: {relations: {}}}")
    except Exception:  # whatever the reader of YAML makes of it
        rows.append(("strict", "repeated key"))
    return spark.createDataFrame(rows, "place string, problem string")


_SHORT = "replace(replace({0}, '_', '\\_'), '&', '\\&')".format


@query(
    f"WITH {_OVER}, c AS (SELECT category, row_number() OVER (ORDER BY category) AS i, count(*) OVER () AS n FROM s), "
    f"cell AS (SELECT a.category AS a, b.i AS j, CASE WHEN b.i <= a.i THEN '' ELSE coalesce(printf('%.1f', 1000 * j.jaccard), '--') END AS v FROM c a JOIN c b ON b.i > 1 LEFT JOIN j ON j.category_a = a.category AND j.category_b = b.category WHERE a.i < a.n) "
    f"SELECT {_SHORT('a')} || ' & ' || string_agg(v, ' & ' ORDER BY j) || ' \\\\' AS line FROM cell GROUP BY a"
)
def latex_matrix(spark, d):
    """The upper triangle of shared items, in thousandths, as rows of a LaTeX table."""
    t = table(spark, d, "interactions")
    pairs = interactions.entity_overlap(t.select("category", F.col("item").alias("object")))
    names = sorted(r.category for r in t.filter("category IS NOT NULL").select("category").distinct().collect())
    lines = exports.latex_half_matrix(pairs, "jaccard", names, scale=1000.0).split("\n")
    return spark.createDataFrame([(x,) for x in lines], "line string")
