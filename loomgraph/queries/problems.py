"""Queries p3_ and p4_ with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.common import norm_id, subject_id, table
from loomgraph.operators.references import orphan_references, orphan_report
from loomgraph.operators.wide import long_cells, typed, wide_cells


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    kg = table(spark, d, "kg_triples").filter("relation IS NULL OR relation <> 'hasSubtype'")
    refs = [kg.select(F.lit("kg_triples").alias("source_table"), "row_id", F.coalesce(subject_id("subject"), norm_id("subject")).alias("key"), F.col("loaded_at").alias("at"))]
    for name, row in (("kg_text", "row_id"), ("kg_image", "row_id"), ("documents", "doc_id")):
        refs.append(table(spark, d, name).select(F.lit(name).alias("source_table"), F.col(row).alias("row_id"), norm_id("product_id").alias("key"), F.col("loaded_at").alias("at")))
    parents = table(spark, d, "kg_link").select(norm_id("product_id").alias("key"), F.col("loaded_at").alias("valid_from"), F.col("deleted_at").alias("valid_to"))
    return orphan_references(reduce(DataFrame.unionByName, refs), parents)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("source_table", "row_id")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(_orphans(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    types = table(spark, d, "relation_types")
    return long_cells(wide_cells(table(spark, d, "kg_triples"), types), types)


def p4_wide(spark: SparkSession, d: str) -> DataFrame:
    types = table(spark, d, "relation_types")
    return typed(wide_cells(table(spark, d, "kg_triples"), types), types)


QUERIES = {f.__name__: f for f in (p3_found, p3_report, p4_found, p4_wide)}

WHITE = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _id(c: str) -> str:
    return f"upper(regexp_replace({c}, '{WHITE}', '', 'g'))"


_TAIL = "list_extract(string_split(subject, '##'), -1)"
_P3 = f"""
WITH refs AS (
  SELECT 'kg_triples' AS source_table, row_id, {_id(_TAIL)} AS key, loaded_at AS moment FROM kg_triples WHERE relation IS DISTINCT FROM 'hasSubtype'
  UNION ALL SELECT 'kg_text', row_id, {_id('product_id')}, loaded_at FROM kg_text
  UNION ALL SELECT 'kg_image', row_id, {_id('product_id')}, loaded_at FROM kg_image
  UNION ALL SELECT 'documents', doc_id, {_id('product_id')}, loaded_at FROM documents),
parents AS (SELECT {_id('product_id')} AS key, loaded_at AS valid_from, deleted_at AS valid_to FROM kg_link),
orphans AS (
  SELECT r.*, (SELECT count(*) FROM parents p WHERE p.key = r.key) AS n_any,
         (SELECT count(*) FROM parents p WHERE p.key = r.key AND p.valid_from <= r.moment) AS n_begun
  FROM refs r WHERE r.key IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM parents p WHERE p.key = r.key AND p.valid_from <= r.moment AND (p.valid_to IS NULL OR p.valid_to > r.moment)))
"""
_READ = f"""
WITH base AS (
  SELECT {_id(_TAIL)} AS product_id, relation, value, loaded_at, row_id,
         lower(trim(regexp_replace(value, '{WHITE}+', ' ', 'g'))) AS t
  FROM kg_triples WHERE contains(subject, '##') AND value IS NOT NULL),
parts AS (
  SELECT *, regexp_extract(t, '^(\\d+(?:[.,]\\d+)?) ?([a-z]*)\\.?$', ['n', 'u']) AS w,
    CASE WHEN regexp_matches(t, '^\\d{{4}}[-/.]\\d{{1,2}}[-/.]\\d{{1,2}}$') THEN regexp_extract(t, '^(\\d+)[-/.](\\d+)[-/.](\\d+)$', ['y', 'm', 'd'])
         WHEN regexp_matches(t, '^\\d{{8}}$') THEN regexp_extract(t, '^(....)(..)(..)$', ['y', 'm', 'd'])
         WHEN regexp_matches(t, '^\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}$') THEN regexp_extract(t, '^(\\d+)\\.(\\d+)\\.(\\d+)$', ['d', 'm', 'y'])
         WHEN regexp_matches(t, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN regexp_extract(t, '^(\\d+)/(\\d+)/(\\d+)$', ['m', 'd', 'y'])
         WHEN regexp_matches(t, '^[a-z]{{3}}[a-z]*\\.? \\d{{1,2}},? \\d{{4}}$') THEN regexp_extract(t, '^([a-z]{{3}})[a-z]*\\.? (\\d+),? (\\d+)$', ['m', 'd', 'y'])
         WHEN regexp_matches(t, '^\\d{{1,2}}\\.? [a-z]{{3}}[a-z]*\\.?,? \\d{{4}}$') THEN regexp_extract(t, '^(\\d+)\\.? ([a-z]{{3}})[a-z]*\\.?,? (\\d+)$', ['d', 'm', 'y'])
    END AS dt,
    regexp_extract(t, '^(?:us ?\\$|usd|\\$)? ?(\\d+(?:[.,]\\d{{3}})*)[.,](\\d{{2}}) ?(?:us ?\\$|usd|\\$)?$', ['a', 'b']) AS pr,
    regexp_extract(t, '^(?:pt ?)?(?:(\\d+) ?h(?:ours?|rs?\\.?)?)?(?:,? ?(?:and )?(\\d+) ?m(?:in(?:ute)?s?\\.?)?)?$', ['h', 'm']) AS hm,
    regexp_extract(t, '^(\\d{{1,3}}):([0-5]\\d)(?::[0-5]\\d)?$', ['h', 'm']) AS ck
  FROM base),
cells AS (
  SELECT product_id, c.column_name, c.data_type, relation, loaded_at, row_id, CASE
    WHEN c.unit = 'pages' THEN CAST(TRY_CAST(replace(regexp_extract(t, '^(?:(?:approx|about|ca|circa)\\.? |~ ?)?(\\d{{1,3}}(?:,\\d{{3}})+|\\d+) ?(?:pages?|pgs?\\.?|pp?\\.?|seiten)?$', 1), ',', '') AS BIGINT) AS VARCHAR)
    WHEN c.unit = 'minutes' THEN CAST(CASE
      WHEN ck.h <> '' THEN CAST(ck.h AS BIGINT) * 60 + CAST(ck.m AS BIGINT)
      WHEN hm.h <> '' OR hm.m <> '' THEN coalesce(TRY_CAST(hm.h AS BIGINT), 0) * 60 + coalesce(TRY_CAST(hm.m AS BIGINT), 0)
      ELSE TRY_CAST(regexp_extract(t, '^(\\d+)$', 1) AS BIGINT) END AS VARCHAR)
    WHEN c.unit = 'g' THEN CAST(CAST(floor((TRY_CAST(replace(w.n, ',', '.') AS DECIMAL(12,4)) * CASE
      WHEN w.u IN ('', 'g', 'gr', 'gram', 'grams') THEN 1 WHEN w.u IN ('kg', 'kgs', 'kilogram', 'kilograms') THEN 1000 WHEN w.u = 'mg' THEN 0.001
      WHEN w.u IN ('oz', 'ounce', 'ounces') THEN 28.349523125 WHEN w.u IN ('lb', 'lbs', 'pound', 'pounds') THEN 453.59237 END) * 10 + 0.5) AS DECIMAL(18,1)) / 10 AS DECIMAL(18,1))::VARCHAR
    WHEN c.unit = 'USD' THEN CASE WHEN pr.a <> '' THEN CAST(CAST(replace(replace(pr.a, ',', ''), '.', '') || '.' || pr.b AS DECIMAL(18,2)) AS VARCHAR) END
    WHEN c.data_type = 'date' THEN CAST(TRY_CAST(dt.y || '-' || coalesce(lpad(CAST(nullif(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], dt.m), 0) AS VARCHAR), 2, '0'), lpad(dt.m, 2, '0')) || '-' || lpad(dt.d, 2, '0') AS DATE) AS VARCHAR)
    WHEN c.data_type = 'boolean' THEN CASE WHEN t IN ('true', 't', 'yes', 'y', '1') THEN 'true' WHEN t IN ('false', 'f', 'no', 'n', '0') THEN 'false' END
    ELSE CASE WHEN t <> '' THEN value END END AS cell
  FROM parts JOIN relation_types c USING (relation)),
best AS (
  SELECT product_id, column_name, data_type, cell FROM cells WHERE cell IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id, column_name ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1)
"""

ORACLE = {
    "p3_found": _P3 + "SELECT source_table, row_id FROM orphans",
    "p3_report": _P3
    + """SELECT source_table, strftime(moment, '%Y-%m') AS month,
      CASE WHEN n_any = 0 THEN 'missing' WHEN moment IS NULL THEN 'undated' WHEN n_begun = 0 THEN 'late' ELSE 'deleted' END AS status,
      count(*) AS n_rows FROM orphans GROUP BY ALL""",
    "p4_found": _READ + "SELECT product_id, column_name, cell FROM best WHERE data_type <> 'string'",
    "p4_wide": _READ
    + """SELECT product_id,
      max(cell) FILTER (column_name = 'author') AS author, max(cell) FILTER (column_name = 'brand') AS brand,
      max(cell) FILTER (column_name = 'category') AS category, max(cell) FILTER (column_name = 'color') AS color,
      max(cell) FILTER (column_name = 'country_of_origin') AS country_of_origin, max(cell) FILTER (column_name = 'director') AS director,
      max(cell) FILTER (column_name = 'material') AS material, max(cell) FILTER (column_name = 'special_feature') AS special_feature,
      CAST(max(cell) FILTER (column_name = 'weight_g') AS DOUBLE) AS weight_g, CAST(max(cell) FILTER (column_name = 'list_price') AS DOUBLE) AS list_price,
      CAST(max(cell) FILTER (column_name = 'page_count') AS BIGINT) AS page_count, CAST(max(cell) FILTER (column_name = 'runtime_minutes') AS BIGINT) AS runtime_minutes,
      CAST(max(cell) FILTER (column_name = 'release_date') AS DATE) AS release_date, CAST(max(cell) FILTER (column_name = 'water_resistant') AS BOOLEAN) AS water_resistant
      FROM best GROUP BY product_id""",
}
