"""The registry of value operators: each turns an array of strings into an array of strings.

Operators of Spark expressions stay in the JVM; those that need Python are pandas UDFs over arrays that handle each distinct value of
a batch once. After each operator values are collapsed and empty ones dropped. Nulls inside arrays are dropped, a null array stays null.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions import lexicon as lex
from loomgraph.functions import measures as ms
from loomgraph.functions import persons as ps
from loomgraph.functions import text as tx

STRINGS = T.ArrayType(T.StringType())
#: Tables of more entries are looked up in a Python dictionary, as a map literal is searched from its start.
MAP_LITERAL = 48
#: Operators that count in a first pass and apply what was learned in a second.
LEARNED = ("canon_by_freq", "fold_by_prefix", "fold_partial_names", "fold_plural", "min_support")

#: Separators, words that stay small in titles, and words for yes and no (fixed values).
SEPARATORS = [",", ";", "|", "/", " & ", " and ", "•"]
STRONG, WEAK = [";", "|", "•"], [" & ", " and ", " + ", "/", ","]
SMALL_WORDS = ["a", "an", "and", "the", "of", "or", "for", "in", "on", "at", "to", "by", "with", "from", "de", "du", "des", "la", "le", "les", "et"]
YES = ["yes", "y", "true", "t", "1", "oui", "vrai", "si", "required", "include", "included", "with", "available", "supported", "enabled"]
NO = ["no", "n", "false", "f", "0", "non", "faux", "none", "not required", "no batteries required", "not included", "without", "not available", "na", "n/a", "not enabled", "disabled"]


@dataclass
class Env:
    """What operators may refer to: rule tables by dotted path, rules for persons, the relation they work for."""

    rules: dict[str, Any] = field(default_factory=dict)
    persons: dict[str, Any] = field(default_factory=dict)
    relation: str = ""

    def rule(self, path: str | None, kind: type) -> Any:
        """The table at ``alias.table``; an empty one where the path leads nowhere."""
        at: Any = self.rules
        for part in (path or "").split("."):
            at = at.get(part) if isinstance(at, dict) else None
        return at if isinstance(at, kind) else kind()


@dataclass
class Result:
    """values, and sides: array<struct<relation, value>> of triples for other relations, taxonomy: array<struct<parent, relation, child>>."""

    values: Column
    sides: Column | None = None
    taxonomy: Column | None = None


Operator = Callable[[Column, dict[str, Any], Env], "Column | Result"]
OPERATORS: dict[str, Operator] = {}


def op(name: str) -> Callable[[Operator], Operator]:
    def register(f: Operator) -> Operator:
        OPERATORS[name] = f
        return f

    return register


def each(col: Column, f: Callable[[Column], Column]) -> Column:
    return F.transform(col, f)


def tidy(col: Column) -> Column:
    return F.filter(F.transform(col, tx.collapse), lambda v: v.isNotNull() & (v != ""))


def distinct_by(col: Column, key: Callable[[Column], Column], keep_empty: bool = False) -> Column:
    """The first value of each key, in order; values with an empty key go unless kept."""
    keys = F.transform(col, key)
    first = F.filter(F.transform(col, lambda v, i: F.struct(v.alias("v"), key(v).alias("k"), i.alias("i"))), lambda s: F.array_position(keys, s["k"]) == s["i"] + 1)
    first = first if keep_empty else F.filter(first, lambda s: s["k"] != "")
    return F.transform(first, lambda s: s["v"])


def python(col: Column, f: Callable[[list[str]], list[str]]) -> Column:
    """f over whole arrays."""

    @F.pandas_udf(STRINGS)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda vs: None if vs is None else f([v for v in vs if v is not None]))

    return run.asNondeterministic()(col)  # so the optimiser neither repeats nor moves it


def python_each(col: Column, f: Callable[[str], list[str] | str | None]) -> Column:
    """f over single values; None drops, a list spreads."""

    @F.pandas_udf(STRINGS)
    def run(s: pd.Series) -> pd.Series:
        memo: dict[str, list[str]] = {}

        def one(v: str) -> list[str]:
            if v not in memo:
                r = f(v)
                memo[v] = [] if r is None else [r] if isinstance(r, str) else list(r)
            return memo[v]

        return s.map(lambda vs: None if vs is None else [x for v in vs if v is not None for x in one(v)])

    return run.asNondeterministic()(col)


def literal_map(table: dict[str, Any], kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(table)), f"map<string,{kind}>")


def quoted(separators: list[str]) -> str:
    return "|".join(f"\\Q{s}\\E" for s in sorted(separators, key=len, reverse=True))


def split_by(v: Column, separators: list[str], min_len: int) -> Column:
    parts = F.split(v, quoted(separators)) if separators else F.array(v)
    return F.filter(F.transform(parts, tx.collapse), lambda p: F.length(p) >= min_len)


def spread(col: Column, f: Callable[[Column], Column]) -> Column:
    return F.flatten(F.transform(col, f))


# cleaning


def _repair(v: str) -> str:
    import unicodedata

    return v if v.isascii() else tx.py_repair(unicodedata.normalize("NFKC", v))


#: Operators on single values that need Python; neighbours of a pipeline run in one UDF.
PURE: dict[str, Callable[[str], str]] = {"strip_html": tx.py_unescape, "fix_encoding": _repair}


def chained(names: list[str]) -> Callable[[str], str | None]:
    steps = [PURE[n] for n in names]

    def run(v: str) -> str | None:
        for f in steps:
            v = tx.py_collapse(f(v))
            if not v:
                return None
        return v

    return run


@op("strip_html")
def _(col, p, env):
    return python_each(col, PURE["strip_html"])


@op("fix_encoding")
def _(col, p, env):
    return python_each(col, PURE["fix_encoding"])


@op("collapse_ws")
def _(col, p, env):
    return each(col, tx.collapse)


@op("lower")
def _(col, p, env):
    return each(col, F.lower)


@op("upper")
def _(col, p, env):
    return each(col, F.upper)


@op("title_case")
def _(col, p, env):
    def title(v: Column) -> Column:
        words = F.split(v, " ")
        last = F.size(words) - 1

        def word(w: Column, i: Column) -> Column:
            short = (F.length(w) <= 4) & (w == F.upper(w)) & w.rlike(r"\p{L}")
            small = F.lower(w).isin(SMALL_WORDS) & (i > 0) & (i < last)
            return F.when(short, w).when(small, F.lower(w)).when(w.rlike(r"^\p{L}"), F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))).otherwise(w)

        return F.array_join(F.filter(F.transform(words, word), lambda w: w != ""), " ")

    return each(col, title)


@op("strip_chars")
def _(col, p, env):
    chars = F.lit(p.get("chars", " .,;:-*_|/\\\"'"))
    return each(col, lambda v: F.btrim(v, chars))


@op("strip_parenthetical")
def _(col, p, env):
    return each(col, lambda v: F.regexp_replace(v, r"[(\[][^)\]]*[)\]]", " "))


@op("truncate")
def _(col, p, env):
    n = F.lit(int(p.get("max_len", 120)))
    return each(col, lambda v: F.regexp_replace(F.left(v, n), r"(?U)\s+$", ""))


# splitting


@op("split_multi")
def _(col, p, env):
    return spread(col, lambda v: split_by(v, list(p.get("separators", SEPARATORS)), int(p.get("min_len", 2))))


@op("split_smart")
def _(col, p, env):
    """mode always: at every separator. Mode evidence: at the strong ones here; the weak ones are decided by what was learned (see learn.py)."""
    strong, weak = list(p.get("strong", STRONG)), list(p.get("weak", WEAK))
    if p.get("mode", "evidence") == "always":
        strong = strong + weak
    return spread(col, lambda v: split_by(v, strong, int(p.get("min_len", 3))))


@op("strip_roles")
def _(col, p, env):
    roles = frozenset(str(r).strip().lower() for r in p["roles"]) if p.get("roles") else ps.ROLES
    roles |= {str(r).strip().lower() for r in p.get("extra_roles") or []}
    labels = None if p.get("keep_labels") else [str(x) for x in p.get("labels") or ps.LABELS]
    return python_each(col, lambda v: ps.without_roles(v, roles, labels))


@op("keep_roles")
def _(col, p, env):
    wanted = [str(r).lower() for r in p.get("roles") or ["author"]]
    role = r"\(([^)]{2,30})\)\s*$"

    def keep(v: Column) -> Column:
        pieces = F.filter(F.transform(F.split(v, ","), lambda s: F.trim(s)), lambda s: s.rlike(role))
        named = F.filter(pieces, lambda s: F.lower(F.trim(F.regexp_extract(s, role, 1))).isin(wanted))
        return F.when(F.contains(v, F.lit("(")) & (F.size(pieces) > 0), F.transform(named, lambda s: F.regexp_replace(s, role, ""))).otherwise(F.array(v))

    return spread(col, keep)


@op("max_values")
def _(col, p, env):
    return F.slice(distinct_by(col, tx.match_key, keep_empty=True), 1, int(p.get("n", 3)))


# filtering


@op("drop_values")
def _(col, p, env):
    bad = sorted({tx.py_key(str(v)) for v in [*env.rule(p.get("rules_ref"), list), *p.get("values", [])]})
    return F.filter(col, lambda v: ~tx.match_key(v).isin(bad)) if bad else col


def _any_of(patterns: list[str]) -> str:
    return "(?iU)" + "|".join(f"(?:{x})" for x in patterns)


@op("drop_matching")
def _(col, p, env):
    patterns = [str(x) for x in [*p.get("patterns", []), *env.rule(p.get("rules_ref"), list)]]
    return F.filter(col, lambda v: ~v.rlike(_any_of(patterns))) if patterns else col


@op("keep_matching")
def _(col, p, env):
    patterns = [str(x) for x in p.get("patterns", [])]
    return F.filter(col, lambda v: v.rlike(_any_of(patterns))) if patterns else col


@op("drop_long")
def _(col, p, env):
    n = int(p.get("max_len", 100))
    return F.filter(col, lambda v: F.length(v) <= n)


@op("drop_numeric")
def _(col, p, env):
    return F.filter(col, lambda v: ~v.rlike(r"(?U)^[\d\s.,%-]+$"))


# mapping


@op("map")
def _(col, p, env):
    table = dict(p.get("table") or {}) | env.rule(p.get("rules_ref"), dict)
    if not table:
        return col
    sep, strict, tight = str(p.get("split_result", ",")), bool(p.get("strict")), bool(p.get("tight"))
    targets = {tx.py_key(str(k)): [x.strip() for x in str(v).split(sep) if x.strip()] for k, v in table.items()}

    def look(v: str) -> list[str]:
        k = tx.py_key(v)
        hit = targets.get(k)
        if hit is None and tight:
            hit = targets.get(k.replace(" ", ""))
        return hit if hit is not None else [] if strict else [v]

    if len(targets) > MAP_LITERAL:
        return python_each(col, look)
    lookup = literal_map(targets, "array<string>")

    def native(v: Column) -> Column:
        hit = F.try_element_at(lookup, tx.match_key(v))
        hit = F.coalesce(hit, F.try_element_at(lookup, tx.tight_key(v))) if tight else hit
        return F.coalesce(hit, F.array().cast("array<string>") if strict else F.array(v))

    return spread(col, native)


@op("regex_map")
def _(col, p, env):
    rules = p.get("rules") or env.rule(p.get("rules_ref"), list)
    whole = bool(p.get("whole", True))

    def java(replacement: str) -> str:
        import re

        return re.sub(r"\\(\d)", r"$\1", str(replacement).replace("$", r"\$"))

    def apply(v: Column) -> Column:
        out = None
        for pattern, replacement in rules:
            pattern = f"(?iU){pattern}"
            new = F.lit(str(replacement)) if whole else F.regexp_replace(v, pattern, java(replacement))
            out = F.when(v.rlike(pattern), new) if out is None else out.when(v.rlike(pattern), new)
        return out.otherwise(v)

    return each(col, apply) if rules else col


@op("prefix_map")
def _(col, p, env):
    table = dict(p.get("table") or {}) | env.rule(p.get("rules_ref"), dict)
    groups = [(str(c), [k for k in (tx.py_key(str(x)).replace(" ", "") for x in keys) if k]) for c, keys in table.items()]
    groups = [(c, keys) for c, keys in groups if keys]

    def apply(v: Column) -> Column:
        key, out = tx.tight_key(v), None
        for canon, keys in groups:
            test = key.rlike("|".join(f"\\Q{k}\\E" for k in keys))
            out = F.when(test, F.lit(canon)) if out is None else out.when(test, F.lit(canon))
        return out.otherwise(v)

    return each(col, apply) if groups else col


# domains


@op("person_name")
def _(col, p, env):
    rules = ps.PersonRules(env.persons, int(p.get("min_tokens", 2)), int(p.get("max_len", 80)))
    return python_each(col, rules)


@op("language_base")
def _(col, p, env):
    pattern = r"^([^(\[]+)[(\[]([^)\]]+)[)\]]\s*$"
    base = each(col, lambda v: F.when(v.rlike(pattern), F.trim(F.regexp_extract(v, pattern, 1))).otherwise(v))
    relation = p.get("audio_relation")
    if not relation:
        return base
    audio = F.filter(F.transform(col, lambda v: F.trim(F.regexp_extract(v, pattern, 2))), lambda a: a != "")
    return Result(base, F.transform(F.array_distinct(audio), lambda a: F.struct(F.lit(relation).alias("relation"), a.alias("value"))))


def _bins(p: dict, env: Env, ref: str = "rules_ref") -> list:
    return p.get("bins") or env.rule(p.get(ref) or p.get("bins_ref"), list)


def _present(col: Column) -> Column:
    return F.filter(col, lambda v: v.isNotNull())


def _binned_with_raw(read: Callable[[Column], Column]) -> Operator:
    def run(col, p, env):
        bins = _bins(p, env)
        numbers = each(col, read)
        labels = _present(F.transform(numbers, lambda n: tx.binned(n.cast("double"), bins) if bins else n.cast("string")))
        if not p.get("raw_relation"):
            return labels
        raw = F.array_distinct(F.transform(_present(numbers), lambda n: n.cast("string")))
        return Result(labels, F.transform(raw, lambda a: F.struct(F.lit(p["raw_relation"]).alias("relation"), a.alias("value"))))

    return run


OPERATORS["parse_pages_bin"] = _binned_with_raw(ms.pages)
OPERATORS["parse_runtime_bin"] = _binned_with_raw(ms.runtime)


@op("parse_numeric_bin")
def _(col, p, env):
    bins = _bins(p, env)
    return _present(each(col, lambda v: tx.binned(tx.number_in(v), bins) if bins else tx.number_in(v).cast("string")))


@op("normalize_dimensions")
def _(col, p, env):
    unit, assumed = str(p.get("unit", "cm")).lower(), p.get("assume_unit")
    most, decimals, drop = int(p.get("max_dims", 3)), int(p.get("decimals", 1)), bool(p.get("drop_unparsed"))
    return python_each(col, lambda v: ms.written_dimensions(v, unit, assumed and str(assumed).lower(), most, decimals) or (None if drop else v))


@op("convert_measure")
def _(col, p, env):
    family = str(p.get("family", "mass")).lower()
    if family not in ms.FAMILIES:
        return F.array().cast("array<string>")
    base, factors = ms.FAMILIES[family][0], ms.units(family)
    to = str(p.get("to") or base).lower()
    to = to if to in factors else base
    bins, decimals = p.get("bins") or env.rule(p.get("bins_ref"), list), int(p.get("decimals", 0))

    def convert(v: Column) -> Column:
        n = ms.quantity(v, family, p.get("assume_unit")) / factors[to]
        out = tx.binned(n, bins) if bins else F.concat(ms.written_number(n, decimals), F.lit(f" {to}"))
        return F.when(n.isNull(), v).otherwise(out) if p.get("keep_unparsed") else out

    return _present(each(col, convert))


@op("dimension_volume")
def _(col, p, env):
    unit, assumed, decimals = str(p.get("unit", "cm")).lower(), p.get("assume_unit"), int(p.get("decimals", 0))
    bins = p.get("bins") or env.rule(p.get("bins_ref"), list)

    def label(v: str) -> str | None:
        n = ms.volume(v, unit, assumed and str(assumed).lower())
        if n is None:
            return None
        if not bins:
            return f"{ms.trimmed_number(n, decimals)} {unit}3"
        return next((str(b[0]) for b in bins if (b[1] is None or n >= b[1]) and (b[2] is None or n <= b[2])), None)

    return python_each(col, label)


@op("boolean_flag")
def _(col, p, env):
    true = [*YES, *[str(x).strip().lower() for x in p.get("true_values") or []]]
    false = [*NO, *[str(x).strip().lower() for x in p.get("false_values") or []]]
    yes, no = F.lit(str(p.get("label", "Yes"))), F.lit(str(p.get("label_false", "No")))
    both = str(p.get("emit", "true_only")).lower() == "both"

    def flag(v: Column) -> Column:
        key = F.lower(F.btrim(v, F.lit(" .!?")))
        out = F.when(key.isin(true), yes)
        return out.when(key.isin(false), no) if both else out

    return _present(each(col, flag))


@op("parse_age_bin")
def _(col, p, env):
    bins, unit = _bins(p, env, "bins_ref"), str(p.get("default_unit", "years")).lower()

    def band(v: Column) -> Column:
        m = ms.least_months(v, unit)
        return tx.binned(m, bins) if bins and not p.get("months") else F.concat(F.bround(m, 0).cast("bigint").cast("string"), F.lit(" months"))

    return _present(each(col, band))


# vocabularies


@op("match_lexicon")
def _(col, p, env):
    entries = dict(p.get("lexicon") or {}) | {str(k).lower(): v for k, v in env.rule(p.get("rules_ref"), dict).items()}
    lexicon, mode, most = lex.Lexicon(entries), str(p.get("mode", "all")).lower(), int(p.get("max_terms", 3))
    return python(col, lambda vs: lex.lexicon_terms(vs, lexicon, mode, most))


@op("match_subtype")
def _(col, p, env):
    types = lex.Lexicon({str(k).lower(): v for k, v in (p.get("types") or env.rule(p.get("type_rules_ref"), dict)).items()})
    nested = {str(t): lex.Lexicon({str(k).lower(): x for k, x in terms.items()}) for t, terms in (p.get("subtypes") or env.rule(p.get("rules_ref"), dict)).items()}
    most, relation = int(p.get("max_terms", 2)), str(p.get("taxo_relation", "hasSubtype"))

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("parent", T.StringType()), T.StructField("child", T.StringType())])))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda vs: None if vs is None else [{"parent": a, "child": b} for a, b in lex.subtypes([v for v in vs if v is not None], types, nested, most)])

    pairs = run.asNondeterministic()(col)
    return Result(
        F.transform(pairs, lambda s: s["child"]), None, F.transform(pairs, lambda s: F.struct(s["parent"].alias("parent"), F.lit(relation).alias("relation"), s["child"].alias("child")))
    )


@op("extract_sizes")
def _(col, p, env):
    unit, most = str(p.get("unit", "cm")).lower(), int(p.get("max_terms", 4))
    return python(col, lambda vs: lex.sizes(vs, unit, most))


@op("category_path")
def _(col, p, env):
    out = F.when(F.size(col) > 1, F.slice(col, 2, 1 << 20)).otherwise(col) if p.get("skip_root") else col
    if p.get("leaf_only"):
        return F.slice(out, -1, 1) if not p.get("skip_root") else F.when(F.size(out) > 0, F.slice(out, -1, 1)).otherwise(out)
    return F.slice(out, 1, int(p["max_depth"])) if p.get("max_depth") else out


# learned operators change nothing here; learn.py counts their input and plans/build.py applies what was learned


def _unchanged(col, p, env):
    return col


for _name in LEARNED:
    OPERATORS[_name] = _unchanged
OPERATORS["match_learned"] = _unchanged


def step(entry: Any) -> tuple[str, dict[str, Any]] | None:
    """(name, parameters) of an entry of a pipeline: a bare name, or a mapping with op (or name); anything else is ignored."""
    if isinstance(entry, str):
        return entry, {}
    if isinstance(entry, dict) and (name := entry.get("op") or entry.get("name")):
        return str(name), {k: v for k, v in entry.items() if k not in ("op", "name")}
    return None


def apply(col: Column, name: str, params: dict[str, Any], env: Env) -> Result:
    """One operator with the clean-up that follows each."""
    if name not in OPERATORS:
        raise ValueError(f"unknown operation {name!r} in relation {env.relation!r}")
    got = OPERATORS[name](col, params, env)
    got = got if isinstance(got, Result) else Result(got)
    return Result(tidy(got.values), got.sides, got.taxonomy)


def steps(df: DataFrame, column: str, pipeline: list[Any], env: Env) -> DataFrame:
    """``column`` after all operators of a pipeline that has no learned ones.

    Each operator is a projection of its own, so that one that needs Python is never drawn into a lambda of the next; neighbours that
    need Python for single values share one UDF.
    """
    todo = list(filter(None, map(step, pipeline)))
    while todo:
        pure = 0
        while pure < len(todo) and todo[pure][0] in PURE:
            pure += 1
        if pure > 1:
            df = df.withColumn(column, python_each(F.col(column), chained([n for n, _ in todo[:pure]])))
        else:
            pure = 1
            df = df.withColumn(column, apply(F.col(column), *todo[0], env).values)
        todo = todo[pure:]
    return df


def run(df: DataFrame, column: str, pipeline: list[Any], env: Env) -> DataFrame:
    """``column`` after all operators of a pipeline (learned ones change nothing): the first value of each comparison key."""
    return steps(df, column, pipeline, env).withColumn(column, distinct_by(F.col(column), tx.match_key))
