"""Queries of the catalogue engine's own operators, each over its whole table, with SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.common import norm_id, subject_id, table
from loomgraph.functions import text as tx
from loomgraph.operators import audit, graph, interactions, learn, profile
from loomgraph.operators.values import Env, apply
from loomgraph.plans.build import between_relations, build, images, texts
from loomgraph.plans.config import Config, Plan
from loomgraph.sources.exports import ntriples
from loomgraph.sources.records import flat, from_sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WHITE = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}]"
ACCENT = r"regexp_replace({0}, '[\x{{00}}-\x{{7F}}]', '', 'g')"


def C(e: str) -> str:  # noqa: N802
    return f"trim(regexp_replace({e}, '{WHITE}+', ' ', 'g'))"


def K(e: str) -> str:  # noqa: N802
    return f"trim(regexp_replace(lower(strip_accents({e})), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g'))"


def ID(e: str) -> str:  # noqa: N802
    return f"upper(regexp_replace({e}, '{WHITE}', '', 'g'))"


PID = ID("list_extract(string_split(subject, '##'), -1)")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def _of(spark: SparkSession, d: str, relation: str) -> DataFrame:
    return table(spark, d, "kg_triples").filter((F.col("relation") == relation) & F.col("value").isNotNull()).select("row_id", F.array("value").alias("vals"))


def value_query(name: str, op: str, relation: str, params: dict[str, Any] | None = None, sql: str | None = None, rows: str | None = None) -> None:
    """A query of one value operator over all values of a relation: row_id, value. sql is the expression of the new value from v;
    rows, if given, is a whole query from src(row_id, v)."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        got = _of(spark, d, relation).withColumn("vals", apply(F.col("vals"), op, params or {}, Env()).values)
        return got.select("row_id", F.explode("vals").alias("value"))

    run.__name__ = name
    QUERIES[name] = run
    src = f"WITH src AS (SELECT row_id, value AS v FROM kg_triples WHERE relation = '{relation}' AND value IS NOT NULL) "
    if rows:
        ORACLE[name] = src + rows
    elif sql:
        ORACLE[name] = src + f"SELECT row_id, value FROM (SELECT row_id, {C(sql)} AS value FROM src) WHERE value <> ''"


ENTITIES = "regexp_replace(v, '<[^>]{0,400}>', ' ', 'g')"
for _k, _v in (("&nbsp;", "chr(160)"), ("&#8211;", "'–'"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&amp;", "'&'")):
    ENTITIES = f"replace({ENTITIES}, '{_k}', {_v})"
SMALL = "a an and the of or for in on at to by with from de du des la le les et".split()
TITLE = (
    "list_aggregate(list_filter(list_transform(string_split(v, ' '), lambda x, i: CASE WHEN length(x) <= 4 AND x = upper(x) AND regexp_matches(x, '\\p{L}') THEN x "
    f"WHEN list_contains({SMALL}, lower(x)) AND i > 1 AND i < len(string_split(v, ' ')) THEN lower(x) "
    "WHEN regexp_matches(x, '^\\p{L}') THEN upper(x[1:1]) || x[2:] ELSE x END), lambda x: x <> ''), 'string_agg', ' ')"
)
COLOURS = {"noir": "Black", "schwarz": "Black", "snow": "White", "sky_blue": "Sky Blue,Blue", "rouge": "Red", "dunkelblau": "Navy"}
COLOUR_KEYS = {"noir": "Black", "schwarz": "Black", "snow": "White", "sky blue": "Sky Blue,Blue", "rouge": "Red", "dunkelblau": "Navy"}
PAGES = [["short", 1, 199], ["middle", 200, 499], ["long", 500, None]]
MINUTES = [["short", 0, 89], ["feature", 90, 149], ["epic", 150, None]]
PRICES = [["low", 0, 10], ["middle", 10.01, 50], ["high", 50.01, None]]
OUNCES = {"g": 1, "kg": 1000, "oz": 28.349523, "lb": 453.59237, "pounds": 453.59237}
FRAGMENTS = lambda seps, least: f"list_filter(list_transform(regexp_split_to_array(v, '{seps}'), lambda x: {C('x')}), lambda x: length(x) >= {least})"

value_query("op_strip_html", "strip_html", "hasSpecialFeature", sql=ENTITIES)
value_query("op_collapse_ws", "collapse_ws", "hasColor", sql="v")
value_query("op_lower", "lower", "hasMaterial", sql="lower(v)")
value_query("op_upper", "upper", "hasCountryOfOrigin", sql="upper(v)")
value_query("op_title_case", "title_case", "hasBrand", sql=TITLE)
value_query("op_strip_chars", "strip_chars", "hasColor", sql="trim(v, ' .,;:-*_|/\\\"''')")
value_query("op_strip_parenthetical", "strip_parenthetical", "hasMaterial", sql=r"regexp_replace(v, '[(\[][^)\]]*[)\]]', ' ', 'g')")
value_query("op_truncate", "truncate", "hasSpecialFeature", {"max_len": 14}, sql="left(v, 14)")
value_query("op_split_multi", "split_multi", "hasColor", rows=f"SELECT row_id, unnest({FRAGMENTS('[,;|/•]| & | and ', 2)}) AS value FROM src")
value_query("op_split_smart_always", "split_smart", "hasCategory", {"mode": "always"}, rows=f"SELECT row_id, unnest({FRAGMENTS('[;|•/,]| & | and | [+] ', 3)}) AS value FROM src")
value_query("op_strip_roles", "strip_roles", "hasAuthor", sql=f"CASE WHEN regexp_matches(v, '(?i)\\(author\\)') THEN trim({C("regexp_replace(v, '(?i)\\(author\\)', ' ', 'g')")}, ' ,;:-') ELSE v END")
value_query(
    "op_keep_roles", "keep_roles", "hasAuthor", {"roles": ["author"]},
    rows=f"SELECT row_id, value FROM (SELECT row_id, {C('x')} AS value FROM (SELECT row_id, unnest(CASE WHEN contains(v, '(') THEN list_transform(list_filter(string_split(v, ','), lambda x: regexp_matches(trim(x), '(?i)\\(author\\)$')), lambda x: regexp_replace(trim(x), '(?i)\\(author\\)$', '')) ELSE [v] END) AS x FROM src)) WHERE value <> ''",
)
value_query("op_drop_values", "drop_values", "hasMaterial", {"values": ["N/A", "unknown", "other", "see label"]}, rows=f"SELECT row_id, {C('v')} AS value FROM src WHERE {K('v')} NOT IN ('n a', 'unknown', 'other', 'see label')")
value_query("op_drop_matching", "drop_matching", "hasMaterial", {"patterns": [r"\d+ ?layers", r"^model "]}, rows=f"SELECT row_id, {C('v')} AS value FROM src WHERE NOT regexp_matches(v, '(?i)\\d+ ?layers|^model ')")
value_query("op_keep_matching", "keep_matching", "hasCountryOfOrigin", {"patterns": ["^made in", "^product of"]}, rows=f"SELECT row_id, {C('v')} AS value FROM src WHERE regexp_matches(v, '(?i)^made in|^product of')")
value_query("op_drop_long", "drop_long", "hasBrand", {"max_len": 24}, rows=f"SELECT row_id, {C('v')} AS value FROM src WHERE length(v) <= 24")
value_query("op_drop_numeric", "drop_numeric", "hasPageCount", rows=f"SELECT row_id, {C('v')} AS value FROM src WHERE NOT regexp_full_match(v, '[\\d\\s.,%-]+')")
value_query(
    "op_map", "map", "hasColor", {"table": COLOURS},
    rows="SELECT row_id, unnest(CASE " + " ".join(f"WHEN {K('v')} = '{k}' THEN {v.split(',')}" for k, v in COLOUR_KEYS.items()) + f" ELSE [{C('v')}] END) AS value FROM src WHERE {C('v')} <> ''",
)
value_query("op_map_strict", "map", "hasColor", {"table": COLOURS, "strict": True}, rows="SELECT row_id, unnest(CASE " + " ".join(f"WHEN {K('v')} = '{k}' THEN {v.split(',')}" for k, v in COLOUR_KEYS.items()) + " ELSE [] END) AS value FROM src")
value_query("op_regex_map", "regex_map", "hasReleaseDate", {"rules": [[r".*\b((?:19|20)\d\d)\b.*", r"\1"]], "whole": False}, sql=r"regexp_replace(v, '.*\b((?:19|20)\d\d)\b.*', '\1')")
value_query("op_prefix_map", "prefix_map", "hasBrand", {"table": {"Bripabokrol": ["bripabokrol"], "Works": ["works", "wks"]}}, sql=f"CASE WHEN contains(replace({K('v')}, ' ', ''), 'bripabokrol') THEN 'Bripabokrol' WHEN regexp_matches(replace({K('v')}, ' ', ''), 'works|wks') THEN 'Works' ELSE v END")
NUM = r"regexp_replace(coalesce(nullif(regexp_extract(v, '(?i)(\d[\d,.\s]{0,9})\s*(?:pages?|p\.?|pp\.?)\b', 1), ''), regexp_extract(v, '(\d[\d,.\s]*)', 1)), '[^\d]', '', 'g')"
value_query("op_parse_pages_bin", "parse_pages_bin", "hasPageCount", {"bins": PAGES}, rows=f"SELECT row_id, CASE WHEN n < 200 THEN 'short' WHEN n < 500 THEN 'middle' ELSE 'long' END AS value FROM (SELECT row_id, TRY_CAST({NUM} AS BIGINT) AS n FROM src) WHERE n > 0 AND n < 30000")
RUN = r"""CASE WHEN regexp_matches(v, '^\d{1,2}:\d\d') THEN CAST(split_part(v, ':', 1) AS INT) * 60 + CAST(split_part(v, ':', 2) AS INT)
  WHEN regexp_matches(v, '^PT') THEN coalesce(TRY_CAST(regexp_extract(v, '(\d+)H', 1) AS INT), 0) * 60 + coalesce(TRY_CAST(regexp_extract(v, '(\d+)M', 1) AS INT), 0)
  WHEN regexp_matches(v, '(?i)\d ?h') THEN CAST(regexp_extract(v, '^\s*(\d+)', 1) AS INT) * 60 + coalesce(TRY_CAST(regexp_extract(v, '(?i)(\d+) ?m', 1) AS INT), 0)
  ELSE TRY_CAST(regexp_extract(v, '(\d+)', 1) AS INT) END"""
value_query("op_parse_runtime_bin", "parse_runtime_bin", "hasRuntime", {"bins": MINUTES}, rows=f"SELECT row_id, CASE WHEN n < 90 THEN 'short' WHEN n < 150 THEN 'feature' ELSE 'epic' END AS value FROM (SELECT row_id, {RUN} AS n FROM src) WHERE n > 0")
value_query("op_parse_numeric_bin", "parse_numeric_bin", "hasListPrice", {"bins": PRICES}, rows=r"SELECT row_id, value FROM (SELECT row_id, CASE WHEN n BETWEEN 0 AND 10 THEN 'low' WHEN n BETWEEN 10.01 AND 50 THEN 'middle' WHEN n >= 50.01 THEN 'high' END AS value FROM (SELECT row_id, TRY_CAST(regexp_extract(replace(v, ',', ''), '-?\d+(?:\.\d+)?') AS DOUBLE) AS n FROM src)) WHERE value IS NOT NULL")
UNITS = " ".join(f"WHEN '{u}' THEN {f}" for u, f in OUNCES.items())
value_query(
    "op_convert_measure", "convert_measure", "hasItemWeight", {"family": "mass", "to": "kg", "decimals": 2, "bins": [["light", 0, 0.5], ["middle", 0.5, 2], ["heavy", 2, None]]},
    rows=rf"SELECT row_id, CASE WHEN n <= 0.5 THEN 'light' WHEN n <= 2 THEN 'middle' ELSE 'heavy' END AS value FROM (SELECT row_id, TRY_CAST(replace(regexp_extract(v, '^\s*(\d+(?:[.,]\d+)?)\s*([a-zA-Z]+)\s*$', 1), ',', '.') AS DOUBLE) * (CASE lower(regexp_extract(v, '^\s*(\d+(?:[.,]\d+)?)\s*([a-zA-Z]+)\s*$', 2)) {UNITS} END) / 1000 AS n FROM src) WHERE n IS NOT NULL",
)
value_query("op_boolean_flag", "boolean_flag", "isWaterResistant", {"emit": "both"}, rows="SELECT row_id, CASE WHEN lower(trim(v, ' .!?')) IN ('y', 'yes', 'true', '1') THEN 'Yes' ELSE 'No' END AS value FROM src WHERE lower(trim(v, ' .!?')) IN ('y', 'yes', 'true', '1', 'n', 'no', 'false', '0', 'n/a')")
LEX = {"home": "Home", "living": "Home", "kitchen": "Kitchen", "pet": "Pets", "fashion": "Fashion", "bags": "Fashion", "trail": "Outdoor"}
LEXSQL = "list_filter(list_transform(regexp_extract_all(lower(v), '[a-z0-9]+'), lambda x: CASE x " + " ".join(f"WHEN '{k}' THEN '{w}'" for k, w in LEX.items()) + " END), lambda x: x IS NOT NULL)"
for _mode, _pick in (("first", "l[1]"), ("head", "l[-1]")):
    value_query(f"op_match_lexicon_{_mode}", "match_lexicon", "hasCategory", {"lexicon": LEX, "mode": _mode}, rows=f"SELECT row_id, {_pick} AS value FROM (SELECT row_id, {LEXSQL} AS l FROM src) WHERE len(l) > 0")
value_query("op_match_lexicon_all", "match_lexicon", "hasCategory", {"lexicon": LEX}, rows=f"SELECT row_id, unnest(list_distinct(l)) AS value FROM (SELECT row_id, {LEXSQL} AS l FROM src) WHERE len(l) > 0")
value_query("op_match_lexicon_dominant", "match_lexicon", "hasCategory", {"lexicon": LEX, "mode": "dominant"}, rows=f"SELECT row_id, arg_max(x, n * 1000 + i) AS value FROM (SELECT row_id, x, count(*) AS n, max(i) AS i FROM (SELECT row_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT row_id, {LEXSQL} AS l FROM src)) GROUP BY row_id, x) GROUP BY row_id")


def _arrays(spark: SparkSession, d: str, relation: str) -> DataFrame:
    """product_id, vals in the order of row_id; the values of one product and relation."""
    rows = table(spark, d, "kg_triples").filter((F.col("relation") == relation) & F.col("value").isNotNull()).select(subject_id("subject").alias("product_id"), "row_id", "value").filter("product_id IS NOT NULL")
    return rows.groupBy("product_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "value"))), lambda s: s["value"]).alias("vals"))


@query(
    f"WITH s AS (SELECT {PID} AS product_id, row_id, {C('value')} AS value, {K('value')} AS k FROM kg_triples WHERE relation = 'hasColor' AND value IS NOT NULL AND contains(subject, '##')), "
    "f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY product_id, k ORDER BY row_id) = 1) SELECT product_id, value FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY row_id) AS r FROM f) WHERE r <= 2 AND value <> ''"
)
def op_max_values(spark, d):
    got = _arrays(spark, d, "hasColor").withColumn("vals", apply(F.col("vals"), "max_values", {"n": 2}, Env()).values)
    return got.select("product_id", F.explode("vals").alias("value"))


@query("SELECT DISTINCT doc_id, lang AS base FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL AND lang <> ''")
def op_language_base(spark, d):
    docs = table(spark, d, "documents").filter("lang IS NOT NULL AND source IS NOT NULL").select("doc_id", F.array(F.format_string("%s (%s)", "lang", "source")).alias("vals"))
    return docs.select("doc_id", F.explode(apply(F.col("vals"), "language_base", {}, Env()).values).alias("base"))


@query("SELECT doc_id, 'hasAudio' AS relation, source AS value FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def op_language_side(spark, d):
    docs = table(spark, d, "documents").filter("lang IS NOT NULL AND source IS NOT NULL").select("doc_id", F.array(F.format_string("%s (%s)", "lang", "source")).alias("vals"))
    return docs.select("doc_id", F.explode(apply(F.col("vals"), "language_base", {"audio_relation": "hasAudio"}, Env()).sides).alias("s")).select("doc_id", "s.*")


@query("SELECT p_partkey, CASE WHEN p_size >= 36 THEN 'Child' WHEN p_size >= 12 THEN 'Toddler' ELSE 'Infant' END AS band FROM part")
def op_parse_age_bin(spark, d):
    bins = [["Child", 36, None], ["Toddler", 12, 35.9], ["Infant", 0, 11.9]]
    parts = table(spark, d, "part").select("p_partkey", F.array(F.format_string("%d months & up", "p_size")).alias("vals"))
    return parts.select("p_partkey", F.explode(apply(F.col("vals"), "parse_age_bin", {"bins": bins}, Env()).values).alias("band"))


@query("SELECT p_partkey, CAST(p_size * p_size * 2 AS VARCHAR) || ' cm3' AS volume FROM part")
def op_dimension_volume(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.array(F.format_string("%d x %d x 2 cm", "p_size", "p_size")).alias("vals"))
    parts = parts.withColumn("vals", apply(F.col("vals"), "dimension_volume", {}, Env()).values)
    return parts.select("p_partkey", F.explode("vals").alias("volume"))


TYPES = {"kettle": "Kettle", "bag": "Bag", "lamp": "Lamp", "mat": "Mat"}
SUBTYPES = {"Kettle": {"gooseneck": "Gooseneck", "drip": "Drip"}, "Bag": {"dry": "Dry Bag", "sling": "Sling Bag"}, "Lamp": {"desk": "Desk Lamp"}, "Mat": {"yoga": "Yoga Mat"}}


def _subtype(spark, d):
    names = table(spark, d, "kg_link").filter("product_name IS NOT NULL").select("product_id", F.array("product_name").alias("vals"))
    got = apply(F.col("vals"), "match_subtype", {"types": TYPES, "subtypes": SUBTYPES}, Env())
    return names, got


_HAS = lambda w: f"regexp_matches(lower(product_name), '(^|[^a-z0-9]){w}([^a-z0-9]|$)')"
_EDGE = " UNION ".join(f"SELECT DISTINCT '{t}' AS parent, 'hasSubtype' AS relation, '{s}' AS child FROM kg_link WHERE {_HAS(w)} AND {_HAS(t.lower())}" for t, m in SUBTYPES.items() for w, s in m.items())


@query(_EDGE)
def taxonomy_edges(spark, d):
    names, got = _subtype(spark, d)
    return names.select(got.taxonomy.alias("t")).select(F.explode("t").alias("t")).select("t.*").distinct()


@query("SELECT row_id, string_split(value, ' & ')[2] AS value FROM kg_triples WHERE relation = 'hasCategory' AND value IS NOT NULL AND len(string_split(value, ' & ')) > 1 UNION ALL SELECT row_id, value FROM kg_triples WHERE relation = 'hasCategory' AND value IS NOT NULL AND len(string_split(value, ' & ')) = 1")
def op_category_path(spark, d):
    rows = table(spark, d, "kg_triples").filter("relation = 'hasCategory' AND value IS NOT NULL").select("row_id", F.split("value", " & ").alias("vals"))
    return rows.select("row_id", F.explode(apply(F.col("vals"), "category_path", {"skip_root": True, "max_depth": 1}, Env()).values).alias("value"))


@query(f"SELECT row_id, {K('value')} AS k, replace({K('value')}, ' ', '') AS tight FROM kg_triples WHERE relation IN ('hasBrand', 'hasAuthor', 'hasColor') AND value IS NOT NULL")
def match_keys(spark, d):
    rows = table(spark, d, "kg_triples").filter("relation IN ('hasBrand', 'hasAuthor', 'hasColor') AND value IS NOT NULL")
    return rows.select("row_id", tx.match_key(F.col("value")).alias("k"), tx.tight_key(F.col("value")).alias("tight"))


# learned tables

_CNT = "c AS (SELECT relation, value, count(*) AS n, min(row_id) AS f FROM kg_triples WHERE relation IS NOT NULL AND value IS NOT NULL GROUP BY ALL)"
_CANON = f"best AS (SELECT relation, k, value AS target FROM (SELECT *, {K('value')} AS k, length({ACCENT.format('value')}) AS acc FROM c) WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY relation, k ORDER BY n DESC, acc DESC, length(value), value DESC) = 1), canon AS (SELECT c.relation, c.value, b.target FROM c JOIN best b ON c.relation = b.relation AND {K('c.value')} = b.k WHERE c.value <> b.target)"


def _counted(spark, d):
    return learn.counts(table(spark, d, "kg_triples").filter("relation IS NOT NULL"), ["relation"], order="row_id")


@query(f"WITH {_CNT}, {_CANON} SELECT * FROM canon")
def learn_canon_by_freq(spark, d):
    return learn.variant_map(_counted(spark, d), ["relation"])


_KNOWN = "known AS (SELECT relation, value, sum(n)::BIGINT AS n, min(f) AS f FROM (SELECT c.relation, coalesce(k.target, c.value) AS value, c.n, c.f FROM c LEFT JOIN canon k USING (relation, value)) GROUP BY ALL)"


def _known(spark, d):
    c = _counted(spark, d)
    return learn.recount(c, learn.variant_map(c, ["relation"]), ["relation"])


@query(
    f"WITH {_CNT}, {_CANON}, {_KNOWN}, w AS (SELECT *, {K('value')} AS k, string_split({K('value')}, ' ') AS ws FROM known WHERE relation = 'hasBrand'), "
    "s AS (SELECT k, value AS target, n AS tn FROM w WHERE n >= 3 AND k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, f, value DESC) = 1), "
    "l AS (SELECT w.value, w.n, unnest(generate_series(1, len(ws) - 1)) AS cut, ws FROM w WHERE len(ws) > 1) "
    "SELECT 'hasBrand' AS relation, l.value, s.target FROM l JOIN s ON s.k = array_to_string(l.ws[1:cut], ' ') WHERE s.tn >= greatest(l.n, 3) QUALIFY row_number() OVER (PARTITION BY l.value ORDER BY cut) = 1"
)
def learn_fold_by_prefix(spark, d):
    return learn.prefix_map(_known(spark, d).filter("relation = 'hasBrand'"), ["relation"], 3)


@query(
    f"WITH {_CNT}, {_CANON}, {_KNOWN}, w AS (SELECT value, n, string_split(value, ' ') AS ws FROM known WHERE relation = 'hasAuthor'), "
    f"l AS (SELECT value, n, {K("CASE WHEN len(ws) > 2 AND lower(rtrim(ws[-1], '.')) IN ('jr', 'sr', 'ii', 'iii', 'iv', 'phd', 'md', 'esq') THEN ws[-2] ELSE ws[-1] END")} AS k FROM w WHERE len(ws) >= 2) "
    "SELECT 'hasAuthor' AS relation, k, min(value) AS target FROM l GROUP BY k HAVING count(DISTINCT value) = 1 AND sum(n) >= 2"
)
def learn_fold_partial_names(spark, d):
    return learn.surname_map(_known(spark, d).filter("relation = 'hasAuthor'"), ["relation"], 2)


@query(
    f"WITH {_CNT}, p AS (SELECT relation, value, n FROM c WHERE relation IN ('hasCategory', 'hasSpecialFeature')), "
    "h AS (SELECT *, regexp_matches(value, ' & | and | [+] |/|,') AS weak FROM p), "
    f"a AS (SELECT relation, {K('value')} AS k, sum(n) AS seen FROM h WHERE NOT weak GROUP BY ALL), "
    f"x AS (SELECT relation, value, list_filter(list_transform(regexp_split_to_array(value, ' & | and | [+] |/|,'), lambda x: {C('x')}), lambda x: length(x) >= 3) AS fr FROM h WHERE weak), "
    f"y AS (SELECT *, list_transform(fr, lambda x: {K('x')}) AS ks FROM x WHERE len(fr) >= 2), z AS (SELECT relation, value, fr, unnest(ks) AS k FROM y WHERE NOT (len(list_distinct(ks)) < len(ks) AND NOT regexp_matches(value, '[/,]'))) "
    "SELECT z.relation, z.value, array_to_string(fr, '|') AS fragments FROM z LEFT JOIN a USING (relation, k) GROUP BY z.relation, z.value, fr HAVING min(coalesce(seen, 0)) >= 3"
)
def learn_split_smart(spark, d):
    parts = _counted(spark, d).filter("relation IN ('hasCategory', 'hasSpecialFeature')").select("relation", "value", "n")
    return learn.weak_splits(parts, ["relation"]).select("relation", "value", F.array_join("fragments", "|").alias("fragments"))


@query(f"WITH {_CNT}, {_CANON}, {_KNOWN} SELECT t.row_id, coalesce(k.target, t.value) AS value FROM kg_triples t LEFT JOIN canon k USING (relation, value) JOIN known s ON s.relation = t.relation AND s.value = coalesce(k.target, t.value) WHERE t.relation = 'hasBrand' AND s.n >= 5")
def apply_canon_min_support(spark, d):
    """canon_by_freq and min_support as the second pass applies them."""
    c = _counted(spark, d).filter("relation = 'hasBrand'")
    canon = learn.variant_map(c, ["relation"])
    support = learn.recount(c, canon, ["relation"]).filter("n >= 5")
    rows = table(spark, d, "kg_triples").filter("relation = 'hasBrand' AND value IS NOT NULL").select("row_id", "relation", "value")
    rows = rows.join(canon, ["relation", "value"], "left").select("row_id", "relation", F.coalesce("target", "value").alias("value"))
    return rows.join(support.select("relation", "value"), ["relation", "value"]).select("row_id", "value")


# records and graph


@query("SELECT event_id, 'k' AS path, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS value FROM events")
def flatten_json(spark, d):
    rows = table(spark, d, "events").select("event_id", F.explode(flat(F.col("props"))).alias("e"))
    return rows.select("event_id", "e.path", F.explode("e.values").alias("value"))


def _parts_as_records(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.to_json(F.struct(F.col("p_name").alias("title"), F.struct(F.col("p_brand").alias("Brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("Item Type?"))  .alias("details"))).alias("json"))
    return p.withColumn("flat", flat(F.col("json")))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END AS value FROM part")
def source_first(spark, d):
    return _parts_as_records(spark, d).select("p_partkey", F.explode(from_sources(F.col("flat"), ["details/*type*", "details/Brand"])).alias("value"))


@query("SELECT p_partkey, p_brand AS value FROM part UNION ALL SELECT p_partkey, p_type FROM part WHERE p_size % 2 = 0 AND p_type <> p_brand")
def source_all(spark, d):
    return _parts_as_records(spark, d).select("p_partkey", F.explode(from_sources(F.col("flat"), ["details/brand", "details/Item Type"], False)).alias("value"))


@query(f"SELECT product_name AS name, count(*) AS n_homonyms FROM (SELECT {ID('product_id')} AS p, any_value(product_name) AS product_name FROM (SELECT DISTINCT product_id, product_name FROM kg_link WHERE product_name IS NOT NULL) GROUP BY ALL) GROUP BY product_name")
def homonyms(spark, d):
    from loomgraph.plans.build import homonyms as count_homonyms

    names = table(spark, d, "kg_link").filter("product_name IS NOT NULL").groupBy(norm_id("product_id").alias("pid")).agg(F.min("product_name").alias("name"))
    return count_homonyms(names)


@query(f"WITH n AS (SELECT {ID('product_id')} AS pid, min(product_name) AS name FROM kg_link WHERE product_name IS NOT NULL GROUP BY ALL) SELECT pid, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN name || ' ##' || pid ELSE name END AS subject FROM n WHERE pid IS NOT NULL")
def subject_disambiguate(spark, d):
    from loomgraph.plans.build import disambiguated

    names = table(spark, d, "kg_link").filter("product_name IS NOT NULL AND product_id IS NOT NULL").groupBy(norm_id("product_id").alias("pid")).agg(F.min("product_name").alias("name"))
    return disambiguated(names, True).select("pid", "subject")


@query(f"SELECT {PID} AS pid, relation, value FROM kg_triples WHERE contains(subject, '##') AND relation IS NOT NULL AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {PID}, relation, {K('value')} ORDER BY row_id, value) = 1")
def triple_dedup(spark, d):
    from loomgraph.plans.build import unique_triples

    t = table(spark, d, "kg_triples").select(subject_id("subject").alias("pid"), "relation", "value", F.col("row_id").alias("at")).filter("pid IS NOT NULL AND relation IS NOT NULL AND value IS NOT NULL")
    return unique_triples(t).select("pid", "relation", "value")


_TRI = f"SELECT DISTINCT {ID('product_id')} AS product_id FROM kg_link WHERE {ID('product_id')} IN (SELECT {ID('product_id')} FROM kg_text) AND {ID('product_id')} IN (SELECT {ID('product_id')} FROM kg_image)"


def _modalities(spark, d):
    by = lambda n: table(spark, d, n).withColumn("product_id", norm_id("product_id"))
    return by("kg_link"), by("kg_text"), by("kg_image")


@query(_TRI)
def trimodal_filter(spark, d):
    return graph.trimodal(*_modalities(spark, d)).select("product_id").distinct()


@query(f"SELECT relation, count(*) AS n FROM kg_triples WHERE {PID} IN ({_TRI}) AND contains(subject, '##') AND relation NOT IN ('hasListPrice') GROUP BY relation")
def signal_split(spark, d):
    """Triples left per relation after the tri-modal filter, with one relation moved to the signals."""
    kg = table(spark, d, "kg_triples").select(subject_id("subject").alias("product_id"), "relation", "value").filter("product_id IS NOT NULL AND relation IS NOT NULL")
    kept, _ = graph.signal_split(graph.kept_triples(kg, graph.trimodal(*_modalities(spark, d))), ["hasListPrice"])
    return kept.groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH ids AS (SELECT {ID('product_id')} AS p, max(n_homonyms) AS h FROM kg_link WHERE product_id IS NOT NULL GROUP BY ALL), t AS (SELECT DISTINCT {ID('product_id')} AS p FROM kg_text), i AS (SELECT DISTINCT {ID('product_id')} AS p FROM kg_image), k AS (SELECT DISTINCT {PID} AS p FROM kg_triples WHERE contains(subject, '##')) "
    "SELECT count(*) AS products, avg(CASE WHEN p IN (SELECT p FROM t WHERE p IS NOT NULL) THEN 1.0 ELSE 0 END) AS with_text, avg(CASE WHEN p IN (SELECT p FROM i WHERE p IS NOT NULL) THEN 1.0 ELSE 0 END) AS with_image, avg(CASE WHEN p IN (SELECT p FROM i WHERE p IS NOT NULL) AND p IN (SELECT p FROM t WHERE p IS NOT NULL) THEN 1.0 ELSE 0 END) AS with_both, count(*) FILTER (p NOT IN (SELECT p FROM k WHERE p IS NOT NULL)) AS without_triples, count(*) FILTER (h > 1) AS homonyms FROM ids"
)
def audit_coverage(spark, d):
    link, text, image = _modalities(spark, d)
    return graph.coverage(table(spark, d, "kg_triples").select(subject_id("subject").alias("product_id")), link, text, image)


_RV = "rv AS (SELECT relation, value, count(*) AS n FROM kg_triples WHERE relation IS NOT NULL AND value IS NOT NULL GROUP BY ALL)"
_PLAIN = "lower(strip_accents(value))"
_RELAXED = f"regexp_replace({_PLAIN}, '[^0-9a-z]+', '', 'g')"
_WORDS = "list_filter(regexp_split_to_array(lower(strip_accents({0})), '[^0-9a-z]+'), lambda w: w <> '')"
_NUMBERS = r"regexp_matches(trim(value), '^[\d\s.,:/+-]+$')"
_NUMERIC = rf"nr AS (SELECT relation, 2 * count(*) FILTER ({_NUMBERS} OR regexp_matches(trim(value), '(?i)^\s*\d[\d.,]*\s*([-a-z]{{1,3}}\s*\d[\d.,]*|\+)\s*$')) >= count(*) AS num FROM rv GROUP BY relation)"
_FAULT = rf"""CASE WHEN trim(value) = '' THEN 'empty'
 WHEN NOT num AND lower(trim(value)) IN ('n/a', 'na', 'none', 'null', 'unknown', '-', '--', 'other', 'others', 'misc', 'miscellaneous', 'see description', 'not applicable', 'various', 'assorted', 'default', '0', '1', 'no', 'yes') THEN 'noise'
 WHEN regexp_matches(trim(value), '<[^>]+>|&[a-z]+;|&#\d+;') THEN 'html' WHEN length(trim(value)) > 80 THEN 'long' WHEN NOT num AND {_NUMBERS} THEN 'numeric' WHEN NOT num AND length(trim(value)) <= 1 THEN 'short' END"""
_POLL = f"poll AS (SELECT relation, fault, count(*) AS distinct_values, sum(n)::BIGINT AS occurrences FROM (SELECT relation, n, {_FAULT} AS fault FROM rv JOIN nr USING (relation)) WHERE fault IS NOT NULL GROUP BY relation, fault)"


@query(f"WITH {_RV}, {_NUMERIC}, {_POLL} SELECT * FROM poll")
def audit_pollution(spark, d):
    return audit.pollution(audit.relation_values(table(spark, d, "kg_triples")))


_MISSED = f"""ky AS (SELECT *, {_RELAXED} AS key, {_WORDS.format('value')} AS w FROM rv), g AS (
  SELECT relation, 'key' AS family, key AS k, key, value, n FROM ky
  UNION ALL SELECT relation, 'words', array_to_string(list_sort(list_distinct(w)), ' '), key, value, n FROM ky
  UNION ALL SELECT relation, 'first word', w[1], key, value, n FROM ky WHERE length(w[1]) > 3),
h AS (SELECT relation, family, k, count(*) AS n_values, sum(n)::BIGINT AS occurrences, list_sort(list(value)) AS members, count(DISTINCT key) AS keys FROM g WHERE k <> '' GROUP BY relation, family, k HAVING count(*) > 1),
u AS (SELECT * FROM h WHERE family = 'key' OR family = 'first word' AND keys > 1 OR family = 'words' AND (relation, members) NOT IN (SELECT (relation, members) FROM h WHERE family = 'key')),
missed AS (SELECT relation, family, k, n_values, occurrences FROM u QUALIFY row_number() OVER (PARTITION BY relation, family ORDER BY occurrences DESC, k) <= 15)"""


@query(f"WITH {_RV}, {_MISSED} SELECT * FROM missed")
def audit_missed_merges(spark, d):
    return audit.missed_merges(audit.relation_values(table(spark, d, "kg_triples")))


_ODD = f"""mp AS (SELECT t.relation, t.term AS value, c.canonical AS target FROM rule_terms t JOIN canon_values c USING (canonical_id)),
sp AS (SELECT *, list_distinct({_WORDS.format('value')}) AS a, list_distinct({_WORDS.format('target')}) AS b, {_RELAXED} AS ka, {_RELAXED.replace('value', 'target')} AS kb FROM mp),
su AS (SELECT relation, value, target, CASE WHEN len(list_intersect(a, b)) = 0 THEN 'no common word' WHEN len(list_intersect(a, b)) = 1 AND least(len(a), len(b)) >= 2 AND length(list_intersect(a, b)[1]) <= 3 THEN 'weak overlap' END AS reason
  FROM sp WHERE ka <> kb AND len(a) > 0 AND len(b) > 0),
odd AS (SELECT * FROM su WHERE reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY relation ORDER BY value, target) <= 15)"""


def _merges(spark: SparkSession, d: str) -> DataFrame:
    terms, canon = table(spark, d, "rule_terms"), table(spark, d, "canon_values").select("canonical_id", F.col("canonical").alias("target"))
    return terms.join(canon, "canonical_id").select("relation", F.col("term").alias("value"), "target")


@query(f"WITH {_ODD} SELECT relation, value, target, reason FROM odd")
def audit_suspicious_merges(spark, d):
    """Merges of known terms into their canonical entry."""
    return audit.suspicious_merges(_merges(spark, d))


_SCORED = (
    f"{_RV}, {_NUMERIC}, {_POLL}, {_MISSED}, {_ODD}, b AS (SELECT relation, count(*) AS distinct_values, sum(n)::BIGINT AS triples, avg(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS single FROM rv GROUP BY relation), "
    "m AS (SELECT relation, sum(n_values - 1) AS missed FROM missed WHERE family <> 'first word' GROUP BY relation), q AS (SELECT relation, sum(distinct_values) AS dirty FROM poll GROUP BY relation), o AS (SELECT relation, count(*) AS n_odd FROM odd GROUP BY relation), "
    f"p AS (SELECT count(DISTINCT {ID('product_id')}) AS products FROM kg_link), "
    "scored AS (SELECT relation, triples, distinct_values, CAST(round_even(greatest(0, 100 - CASE WHEN single > 0.7 THEN 30 WHEN single > 0.5 THEN 15 ELSE 0 END - CASE WHEN distinct_values / least(triples, products) > 0.8 THEN 25 ELSE 0 END "
    "- least(30, 300 * coalesce(missed, 0) / distinct_values) - least(20, 4 * coalesce(n_odd, 0)) - least(25, 100 * coalesce(dirty, 0) / distinct_values)), 0) AS INTEGER) AS score FROM b CROSS JOIN p LEFT JOIN m USING (relation) LEFT JOIN q USING (relation) LEFT JOIN o USING (relation))"
)


@query(f"WITH {_SCORED} SELECT * FROM scored")
def audit_scores(spark, d):
    products = table(spark, d, "kg_link").select(F.count_distinct(norm_id("product_id"))).first()[0]
    return audit.scores(audit.relation_values(table(spark, d, "kg_triples")), products, _merges(spark, d))


@query(f"WITH {_SCORED} SELECT round(sum(score * triples) / sum(triples), 6) AS score FROM scored")
def audit_global_score(spark, d):
    return audit.global_score(audit_scores(spark, d)).select(F.round("score", 6).alias("score"))


_URL = r"""CASE WHEN url IS NULL OR NOT starts_with(url, 'http') THEN 'not http' WHEN starts_with(url, 'http://') THEN 'insecure'
 WHEN NOT regexp_matches(url, '^https://[^/]+/i/[A-Za-z0-9]+(\._[A-Za-z0-9,]+_)?\.(jpg|jpeg|png)$') THEN 'unexpected form' WHEN NOT regexp_matches(url, '^https://img\d+\.shop\.example/') THEN 'unknown host' WHEN regexp_matches(url, '/i/Q[A-Z0-9]{7}[.]') THEN 'id as name' END"""


@query(f"SELECT {_URL} AS reason, count(*) AS n_rows, count(DISTINCT product_id) AS n_products, min(url) AS example FROM kg_image GROUP BY reason HAVING reason IS NOT NULL")
def url_diagnose(spark, d):
    return graph.url_faults(table(spark, d, "kg_image"))


@query(
    f"WITH i AS (SELECT coalesce(variant, '(none)') AS variant, {ID('product_id')} AS p, {_URL} IS NOT NULL AS faulty FROM kg_image), u AS (SELECT * FROM i UNION ALL SELECT '(all)', p, faulty FROM i), e AS (SELECT count(DISTINCT {ID('product_id')}) AS n FROM kg_link) "
    "SELECT variant, count(*) AS n_rows, count(DISTINCT p) AS n_products, count(*) FILTER (faulty) AS n_faulty, round(100.0 * count(DISTINCT p) / any_value(e.n), 1) AS coverage FROM u CROSS JOIN e GROUP BY variant"
)
def image_form(spark, d):
    tidy = lambda name: table(spark, d, name).withColumn("product_id", norm_id("product_id"))
    return graph.image_form(tidy("kg_image"), tidy("kg_link"))


@query("WITH x AS (SELECT category, count(*) AS n, count(*) FILTER (rating >= 4) AS hits FROM interactions WHERE category IS NOT NULL GROUP BY category), y AS (SELECT *, hits / n AS p, 1.959963984540054 AS z FROM x) SELECT category, round(greatest(0, ((p + z*z/(2*n)) - z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n)), 6) AS low, round(least(1, ((p + z*z/(2*n)) + z * sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n)), 6) AS high FROM y")
def wilson_interval(spark, d):
    x = table(spark, d, "interactions").filter("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rating") >= 4).alias("hits"))
    low, high = graph.wilson(F.col("hits"), F.col("n"))
    return x.select("category", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("SELECT event_type, count(value) AS runs, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS deviation FROM events GROUP BY event_type")
def seed_summary(spark, d):
    s = graph.seed_summary(table(spark, d, "events"), ["event_type"], "value")
    return s.select("event_type", "runs", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


def _plan(**relations: dict) -> Plan:
    return Config({"categories": {"X": {"relations": {k: {"sources": ["x"], **v} for k, v in relations.items()}}}}).plan("X")


def _triples(spark, d, *relations: str) -> DataFrame:
    t = table(spark, d, "kg_triples").filter(F.col("relation").isin(*relations) & F.col("value").isNotNull())
    return t.select(subject_id("subject").alias("pid"), "relation", "value", "row_id").filter("pid IS NOT NULL")


_SRC = f"t AS (SELECT {PID} AS pid, relation, value, row_id FROM kg_triples WHERE contains(subject, '##') AND value IS NOT NULL)"


@query(f"WITH {_SRC} SELECT pid, 'hasMaterial' AS relation, value, row_id FROM t WHERE relation = 'hasMaterial' OR relation = 'hasSpecialFeature' AND pid NOT IN (SELECT pid FROM t WHERE relation = 'hasMaterial')")
def fallback_relation(spark, d):
    """hasSpecialFeature stands in for hasMaterial where a product has none."""
    plan = _plan(hasMaterial={}, hasSpecialFeature={"fallback_for": "hasMaterial"})
    return between_relations(_triples(spark, d, "hasMaterial", "hasSpecialFeature"), plan)


@query(f"WITH {_SRC} SELECT pid, relation, value, row_id FROM t a WHERE relation IN ('hasColor', 'hasMaterial', 'hasCategory') AND NOT (relation = 'hasColor' AND EXISTS (SELECT 1 FROM t b WHERE b.pid = a.pid AND b.relation IN ('hasMaterial', 'hasCategory') AND {K('b.value')} = {K('a.value')}))")
def subsumed_relation(spark, d):
    """A colour that is the product's material or category too goes."""
    plan = _plan(hasColor={"subsumed_by": ["hasMaterial", "hasCategory"]}, hasMaterial={}, hasCategory={})
    return between_relations(_triples(spark, d, "hasColor", "hasMaterial", "hasCategory"), plan)


@query(f"WITH x AS (SELECT row_id AS pid, {C('text')} AS t FROM kg_text WHERE text IS NOT NULL) SELECT pid, CASE WHEN length(t) > 60 THEN regexp_replace(left(t, 60), '\\s\\S*$', '') ELSE t END AS text FROM x WHERE length(t) >= 3")
def text_modality(spark, d):
    """Texts cleaned and cut to 60 characters at a word."""
    rows = table(spark, d, "kg_text").filter("text IS NOT NULL").select(F.col("row_id").alias("pid"), F.create_map(F.lit("text"), F.array("text")).alias("fields"))
    return texts(rows, {"fields": ["text"], "max_chars": 60, "min_chars": 3})


@query(f"WITH x AS (SELECT {ID('product_id')} AS pid, coalesce(variant, 'IMG') AS variant, url, row_id FROM kg_image WHERE product_id IS NOT NULL) SELECT pid, variant, url FROM x WHERE starts_with(url, 'http') QUALIFY row_number() OVER (PARTITION BY pid ORDER BY upper(variant) <> 'MAIN', row_id) = 1")
def image_modality(spark, d):
    """The main picture of each product, or its first usable one."""
    rows = table(spark, d, "kg_image").select(norm_id("product_id").alias("pid"), "row_id", "variant", "url").filter("pid IS NOT NULL")
    entry = F.map_filter(F.create_map(F.lit("variant"), F.col("variant"), F.lit("large"), F.col("url")), lambda k, v: v.isNotNull())
    per = rows.select("pid", "row_id", entry.alias("m")).groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("row_id", F.map_entries("m").alias("e")))).alias("l"))  # the pictures of one product
    return images(per.select("pid", F.transform("l", lambda s: F.map_from_entries(s["e"])).alias("images")), {})


@query(
    "WITH {}, p AS (SELECT x.category AS category_a, y.category AS category_b, count(*) AS shared FROM per x JOIN per y ON x.u = y.u AND x.category < y.category GROUP BY ALL) SELECT category_a, max(shared) FILTER (category_b = 'Books') AS \"Books\", max(shared) FILTER (category_b = 'Movies') AS \"Movies\" FROM p WHERE category_b IN ('Books', 'Movies') GROUP BY category_a"
)
def half_matrix(spark, d):
    """Shared users as columns, two categories only; half_matrix_all has them all."""
    s = interactions.shared_users(table(spark, d, "interactions")).filter("category_b IN ('Books', 'Movies')")
    return interactions.half_matrix(s, "shared", ["Books", "Movies"])


@query(
    "WITH {}, p AS (SELECT x.category AS category_a, y.category AS category_b, count(*) AS shared FROM per x JOIN per y ON x.u = y.u AND x.category < y.category GROUP BY ALL), "
    "m AS (SELECT p.category_a, sz.category AS category_b, p.shared FROM sz LEFT JOIN p ON p.category_b = sz.category) SELECT * FROM (PIVOT m ON category_b USING max(shared) GROUP BY category_a) WHERE category_a IS NOT NULL"
)
def half_matrix_all(spark, d):
    """Shared users as columns, a column for every category."""
    rows = table(spark, d, "interactions")
    categories = sorted(r.category for r in rows.filter("category IS NOT NULL AND user IS NOT NULL").select("category").distinct().collect())  # few
    return interactions.half_matrix(interactions.shared_users(rows), "shared", categories)


# profiles


def _attributes(spark, d):
    return table(spark, d, "kg_triples").select(subject_id("subject").alias("pid"), F.col("relation").alias("key"), "value").filter("pid IS NOT NULL")


@query(
    f"WITH a AS (SELECT {PID} AS pid, relation AS key, value FROM kg_triples WHERE contains(subject, '##') AND relation IS NOT NULL AND value IS NOT NULL), t AS (SELECT count(DISTINCT {PID}) AS total FROM kg_triples WHERE contains(subject, '##')), "
    "p AS (SELECT key, pid, count(*) AS n FROM a GROUP BY ALL), dc AS (SELECT key, count(*) AS docs, avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) > 0.2 AS multivalued FROM p GROUP BY key), "
    f"s AS (SELECT key, count(DISTINCT value) AS distinct_raw, count(DISTINCT {K('value')}) AS distinct_keys, count(*) AS rows, avg(length(value)) AS mean_length FROM a GROUP BY key) "
    "SELECT key, docs, round(docs / total, 6) AS coverage, multivalued, distinct_raw, distinct_keys, round(distinct_raw / rows, 6) AS uniqueness, round(mean_length, 6) AS mean_length, "
    "concat_ws(',', CASE WHEN docs / total < 0.02 THEN 'rare' END, CASE WHEN distinct_keys <= 1 THEN 'constant' END, CASE WHEN distinct_raw / rows > 0.6 AND distinct_keys > 50 AND NOT multivalued THEN 'unique' END, CASE WHEN mean_length > 80 THEN 'long' END) AS reasons FROM dc JOIN s USING (key), t"
)
def discover_profile(spark, d):
    a = _attributes(spark, d)
    total = a.select("pid").distinct().count()
    p = profile.key_profile(a, total)
    return p.select("key", "docs", F.round("coverage", 6).alias("coverage"), "multivalued", "distinct_raw", "distinct_keys", F.round("uniqueness", 6).alias("uniqueness"), F.round("mean_length", 6).alias("mean_length"), "reasons")


@query(
    f"WITH a AS (SELECT DISTINCT relation AS key, {K('x')} AS atom FROM (SELECT relation, unnest(CASE WHEN len(f) > 1 THEN f ELSE [value] END) AS x FROM (SELECT relation, value, list_filter(list_transform(regexp_split_to_array(value, '[,;|]'), lambda x: trim(x)), lambda x: length(x) >= 2) AS f FROM kg_triples WHERE contains(subject, '##') AND relation IS NOT NULL AND value IS NOT NULL)) WHERE {K('x')} <> ''), "
    "s AS (SELECT key, count(*) AS size FROM a GROUP BY key), p AS (SELECT x.key AS key_a, y.key AS key_b, count(*) AS shared FROM a x JOIN a y ON x.atom = y.atom AND x.key < y.key GROUP BY ALL), "
    "j AS (SELECT key_a, key_b, shared, shared / (sa.size + sb.size - shared) AS jaccard, shared / least(sa.size, sb.size) AS containment, least(sa.size, sb.size) AS small FROM p JOIN s sa ON sa.key = key_a JOIN s sb ON sb.key = key_b) "
    "SELECT key_a, key_b, shared, round(jaccard, 6) AS jaccard, round(containment, 6) AS containment, jaccard >= 0.5 OR containment >= 0.85 AS fuse FROM j WHERE small >= 4 AND (jaccard >= 0.01 OR containment >= 0.05)"
)
def discover_redundancy(spark, d):
    r = profile.redundancy(_attributes(spark, d), jaccard=0.01, containment=0.05)
    return r.select("key_a", "key_b", "shared", F.round("jaccard", 6).alias("jaccard"), F.round("containment", 6).alias("containment"), "fuse")


@query(
    "WITH p AS (SELECT relation AS key FROM kg_triples WHERE contains(subject, '##') AND value IS NOT NULL AND relation IS NOT NULL GROUP BY relation), e AS (SELECT lower(relation) AS k FROM relation_types UNION SELECT 'hasscent'), "
    "SELECTED AS (SELECT coalesce(p.key, e.k) AS key, CASE WHEN p.key IS NULL THEN 'dead' WHEN e.k IS NOT NULL THEN 'covered' END AS status FROM p FULL JOIN e ON lower(p.key) = e.k) SELECT * FROM SELECTED WHERE status IS NOT NULL"
)
def compare_attributes(spark, d):
    a = _attributes(spark, d)
    declared = table(spark, d, "relation_types").select(F.col("relation").alias("key")).unionByName(spark.range(1).select(F.lit("hasScent").alias("key")))
    return profile.compared(profile.key_profile(a, a.select("pid").distinct().count()), declared).select("key", "status")


# interactions

_INTER = """i AS (SELECT "user", item, coalesce(rating, 0) AS rating, CASE WHEN ts > 100000000000 THEN ts // 1000 ELSE ts END AS ts FROM interactions WHERE "user" IS NOT NULL AND item IS NOT NULL AND ts IS NOT NULL),
 last AS (SELECT "user", item, rating, ts FROM i QUALIFY row_number() OVER (PARTITION BY "user", item ORDER BY ts DESC, rating DESC) = 1)"""


@query(f"WITH {_INTER} SELECT * FROM last")
def inter_dedup(spark, d):
    return interactions.last_interactions(table(spark, d, "interactions"))


def _core_sql(k: int, rounds: int) -> str:
    out = f'WITH {_INTER}, r0 AS MATERIALIZED (SELECT "user", item FROM last)'
    for i in range(rounds):
        out += f', r{i + 1} AS MATERIALIZED (SELECT * FROM r{i} WHERE "user" IN (SELECT "user" FROM r{i} GROUP BY 1 HAVING count(*) >= {k}) AND item IN (SELECT item FROM r{i} GROUP BY 1 HAVING count(*) >= {k}))'
    return out + f" SELECT * FROM r{rounds}"


@query(_core_sql(4, 24))
def k_core(spark, d):
    pairs = interactions.last_interactions(table(spark, d, "interactions")).select("user", "item")
    return interactions.k_core(pairs, 4)


@query(
    f"""WITH {_INTER}, x AS (SELECT *, count(*) OVER (PARTITION BY "user") AS n, count(*) OVER (PARTITION BY "user") - row_number() OVER (PARTITION BY "user" ORDER BY ts, item) AS back FROM last)
  SELECT "user", item, CASE WHEN back < greatest(1, floor(n * 0.1)) THEN 'test' WHEN back < 2 * greatest(1, floor(n * 0.1)) THEN 'valid' ELSE 'train' END AS split FROM x"""
)
def chrono_split(spark, d):
    return interactions.chronological_split(interactions.last_interactions(table(spark, d, "interactions"))).select("user", "item", "split")


_OBJECTS = f"v AS (SELECT DISTINCT c.value AS category, t.relation, t.value AS object FROM (SELECT {PID} AS p, min(value) AS value FROM kg_triples WHERE relation = 'hasCategory' AND value IS NOT NULL AND contains(subject, '##') GROUP BY ALL) c JOIN (SELECT {PID} AS p, relation, value FROM kg_triples WHERE relation <> 'hasCategory' AND value IS NOT NULL AND contains(subject, '##')) t USING (p))"


def _objects(spark, d):
    t = table(spark, d, "kg_triples").select(subject_id("subject").alias("p"), "relation", "value").filter("p IS NOT NULL AND value IS NOT NULL")
    c = t.filter("relation = 'hasCategory'").groupBy("p").agg(F.min("value").alias("category"))
    return t.filter("relation <> 'hasCategory'").join(c, "p").select("category", "relation", F.col("value").alias("object"))


@query(
    f"WITH {_OBJECTS}, o AS (SELECT DISTINCT category, object FROM v), s AS (SELECT category, count(*) AS n FROM o GROUP BY category) SELECT x.category AS category_a, y.category AS category_b, count(*) AS shared, round(count(*) / (sa.n + sb.n - count(*)), 6) AS jaccard, sa.n AS size_a, sb.n AS size_b "
    "FROM o x JOIN o y ON x.object = y.object AND x.category < y.category JOIN s sa ON sa.category = x.category JOIN s sb ON sb.category = y.category GROUP BY x.category, y.category, sa.n, sb.n"
)
def entity_overlap(spark, d):
    return interactions.entity_overlap(_objects(spark, d)).withColumn("jaccard", F.round("jaccard", 6))


@query(f"WITH {_OBJECTS}, p AS (SELECT x.category AS category_a, y.category AS category_b, x.relation, count(*) AS shared FROM v x JOIN v y ON x.relation = y.relation AND x.object = y.object AND x.category < y.category GROUP BY ALL) SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY category_a, category_b ORDER BY shared DESC, relation) <= 6")
def overlap_by_relation(spark, d):
    return interactions.overlap_by_relation(_objects(spark, d))


_PER = 'per AS (SELECT category, "user" AS u, count(*) AS n FROM interactions WHERE category IS NOT NULL AND "user" IS NOT NULL GROUP BY ALL), sz AS (SELECT category, count(*) AS n FROM per GROUP BY category)'


@query(
    f"WITH {_PER} SELECT x.category AS category_a, y.category AS category_b, count(*) AS shared, count(*) FILTER (x.n >= 5 AND y.n >= 5) AS shared_active, round(count(*) / (sa.n + sb.n - count(*)), 6) AS jaccard, round(count(*) / least(sa.n, sb.n), 6) AS share_of_smaller "
    "FROM per x JOIN per y ON x.u = y.u AND x.category < y.category JOIN sz sa ON sa.category = x.category JOIN sz sb ON sb.category = y.category GROUP BY x.category, y.category, sa.n, sb.n"
)
def shared_users(spark, d):
    s = interactions.shared_users(table(spark, d, "interactions"))
    return s.withColumn("jaccard", F.round("jaccard", 6)).withColumn("share_of_smaller", F.round("share_of_smaller", 6))


@query('WITH u AS (SELECT "user", count(DISTINCT category) AS n FROM interactions WHERE category IS NOT NULL AND "user" IS NOT NULL GROUP BY 1) SELECT count(*) AS users, count(*) FILTER (n > 1) AS users_in_several, round(avg(CASE WHEN n > 1 THEN 1 ELSE 0 END), 6) AS share FROM u')
def user_multi_category(spark, d):
    return interactions.users_of_several(table(spark, d, "interactions")).withColumn("share", F.round("share", 6))


@query(f'WITH {_INTER} SELECT count(DISTINCT "user") AS users, count(DISTINCT item) AS items, count(*) AS interactions, count(*) / (count(DISTINCT "user") * count(DISTINCT item)) AS density FROM last')
def inter_density(spark, d):
    return interactions.density(interactions.last_interactions(table(spark, d, "interactions")))


ORACLE["half_matrix"] = ORACLE["half_matrix"].format(_PER)
ORACLE["half_matrix_all"] = ORACLE["half_matrix_all"].format(_PER)

# exports

_ESC = "replace(replace(replace(replace(replace({0}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"


@query(
    f"WITH k AS (SELECT {PID} AS p, relation, value FROM kg_triples WHERE contains(subject, '##') AND relation IS NOT NULL AND value IS NOT NULL) "
    "SELECT '<https://kg.example/product/' || url_encode(p) || '> <https://kg.example/relation/' || url_encode(relation) || '> <https://kg.example/entity/' || url_encode(relation) || '/' || url_encode(value) || '> .' AS line FROM k "
    f"UNION ALL SELECT DISTINCT '<https://kg.example/entity/' || url_encode(relation) || '/' || url_encode(value) || '> <http://www.w3.org/2000/01/rdf-schema#label> \"' || {_ESC.format('value')} || '\" .' FROM k"
)
def ntriples_export(spark, d):
    """Edges and entity labels as N-Triples; ntriples_graph has the products, texts, pictures and taxonomy too."""
    kg = table(spark, d, "kg_triples").select(subject_id("subject").alias("product_id"), "relation", "value").filter("product_id IS NOT NULL")
    nothing = table(spark, d, "kg_link").limit(0)
    return ntriples(kg, nothing, nothing.withColumn("text", F.lit("")), nothing.withColumn("url", F.lit("")), "https://kg.example/")


_BASE = "https://kg.example/"


@query(
    ORACLE["ntriples_export"]
    + f" UNION ALL SELECT '<{_BASE}product/' || url_encode(p) || '> ' || unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://schema.org/Product> .', '<http://www.w3.org/2000/01/rdf-schema#label> \"' || {_ESC.format("coalesce(product_name, '')")} || '\" .']) FROM (SELECT {ID('product_id')} AS p, product_name FROM kg_link WHERE product_id IS NOT NULL)"
    f" UNION ALL SELECT '<{_BASE}product/' || url_encode({ID('product_id')}) || '> <http://schema.org/description> \"' || {_ESC.format('text')} || '\" .' FROM kg_text WHERE product_id IS NOT NULL AND text IS NOT NULL"
    f" UNION ALL SELECT '<{_BASE}product/' || url_encode({ID('product_id')}) || '> <http://schema.org/image> <' || url || '> .' FROM kg_image WHERE product_id IS NOT NULL AND url IS NOT NULL"
    f" UNION ALL SELECT '<{_BASE}type/' || url_encode(subject) || '> <{_BASE}relation/' || url_encode(relation) || '> <{_BASE}type/' || url_encode(value) || '> .' FROM kg_triples WHERE relation = 'hasSubtype' AND NOT contains(subject, '##') AND value IS NOT NULL"
)
def ntriples_graph(spark, d):
    """The whole graph as N-Triples: products, descriptions, pictures, edges, entity labels and the taxonomy."""
    triples = table(spark, d, "kg_triples")
    kg = triples.select(subject_id("subject").alias("product_id"), "relation", "value").filter("product_id IS NOT NULL")
    link, text, image = (table(spark, d, name).withColumn("product_id", norm_id("product_id")) for name in ("kg_link", "kg_text", "kg_image"))
    taxonomy = triples.filter("relation = 'hasSubtype' AND NOT contains(subject, '##') AND value IS NOT NULL").select(F.col("subject").alias("parent"), "relation", F.col("value").alias("child"))
    return ntriples(kg, link, text, image, _BASE, taxonomy)


# the whole build

DEMO = """
defaults: {id_field: pid, min_relations: 2, subject: {fields: [title], disambiguate: always}, text: {fields: [title], min_chars: 3}}
categories:
  _generic:
    relations:
      hasBrand: {sources: [details/hasBrand], ops: [canon_by_freq, {op: fold_by_prefix, min_count: 3}, {op: min_support, n: 2}]}
      hasColor: {sources: ["details/*Color*"], ops: [{op: drop_values, values: [N/A, see picture]}, {op: split_smart, min_evidence: 3}, title_case, canon_by_freq, {op: max_values, n: 2}]}
      hasCategory: {sources: [details/hasCategory], ops: [{op: split_smart, mode: always}, fold_plural]}
      hasPages: {sources: [details/hasPageCount], ops: [{op: parse_pages_bin, bins: [[short, 1, 199], [long, 200, null]]}]}
      isWaterResistant: {sources: [details/isWaterResistant], ops: [{op: boolean_flag, label: Water resistant}]}
"""


@query()
def kg_build(spark, d, copies: int = 1):
    """Flagship: records with open attributes to a normalised graph, by the two passes of the engine. The benchmark repeats the products under
    new ids to see how it grows."""
    rows = table(spark, d, "kg_triples").select(subject_id("subject").alias("pid"), "relation", "value", "row_id").filter("pid IS NOT NULL AND relation IS NOT NULL AND value IS NOT NULL")
    details = rows.groupBy("pid", "relation").agg(F.max_by("value", "row_id").alias("value"), F.min("row_id").alias("ord"))
    records = details.groupBy("pid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("relation", "value")))).alias("details"), F.min("ord").alias("ord"))  # one value per relation
    names = table(spark, d, "kg_link").groupBy(norm_id("product_id").alias("pid")).agg(F.min("product_name").alias("title"))
    made = records.join(names, "pid")
    if copies > 1:
        made = made.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("pid", F.concat_ws("-", "pid", "copy"))
    products = made.select("pid", "ord", F.to_json(F.struct("title", "details")).alias("json")).select("pid", "ord", flat(F.col("json")).alias("flat"))
    return build(products, Config.parse(DEMO).plan("Everything")).kg
