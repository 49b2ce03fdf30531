"""The text primitives as temporary SQL functions, expanded into the plan like built-ins."""

from __future__ import annotations

from pyspark.sql import SparkSession

from loomgraph.functions.text import _FROM, _SEVERAL, _TO


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession) -> list[str]:
    """Defines collapse_ws, deaccent, match_key, tight_key, strip_tags, number_in, percent_encode; gives their names."""
    plain = "s"
    for k, v in _SEVERAL.items():
        plain = f"replace({plain}, {_quoted(k)}, {_quoted(v)})"
    bodies = {
        "collapse_ws": r"trim(regexp_replace(s, '(?U)(?:\\s|[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F])+', ' '))",
        "deaccent": rf"regexp_replace(translate({plain}, {_quoted(_FROM)}, {_quoted(_TO)}), '\\p{{Mn}}+', '')",
        "match_key": r"trim(regexp_replace(lower(deaccent(s)), '[^\\p{L}\\p{N}\\p{M}]+', ' '))",
        "tight_key": "replace(match_key(s), ' ', '')",
        "strip_tags": "regexp_replace(s, '<[^>]{0,400}>', ' ')",
        "percent_encode": "replace(replace(replace(url_encode(s), '+', '%20'), '*', '%2A'), '%7E', '~')",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN {body}")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION number_in(s STRING) RETURNS DOUBLE RETURN try_cast(nullif(regexp_extract(replace(s, ',', ''), '-?\\d+(?:\\.\\d+)?', 0), '') AS DOUBLE)")
    return [*bodies, "number_in"]
