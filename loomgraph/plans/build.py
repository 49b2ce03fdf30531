"""Builds the graph: values of every relation, tables learned in a first pass, rules between relations, modalities.

The carrier is one row per product and relation with an array of values. Stateless operators are column expressions on it; what was
learned is joined, so tables of any size can be applied (Spark broadcasts those it finds small).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.common import materialize
from loomgraph.functions.text import collapse, match_key
from loomgraph.operators import learn
from loomgraph.operators.values import LEARNED, STRONG, WEAK, Env, apply, distinct_by, python_each, split_by, spread, step, steps
from loomgraph.plans.config import Plan, RelationPlan
from loomgraph.sources.records import from_sources

#: Relations that describe how buyers behave rather than the product (fixed values).
SIGNALS = ("hasPopularity", "hasRatingLevel")
ROW = ["pid", "ord"]


def _evidence(name: str, params: dict) -> bool:
    return name == "split_smart" and params.get("mode", "evidence") == "evidence"


def raw_values(products: DataFrame, relations: list[RelationPlan]) -> DataFrame:
    """pid, ord, of (the relation), vals: the values that each relation starts from, in one pass over the products. products: pid, ord, flat."""
    found = [F.struct(F.lit(r.name).alias("of"), from_sources(F.col("flat"), r.sources, r.first_source_only).alias("vals")) for r in relations]
    return products.select(*ROW, F.explode(F.array(*found)).alias("r")).select(*ROW, "r.of", "r.vals").filter(F.size("vals") > 0)


def strong_parts(col: Column, params: dict) -> Column:
    strong, min_len = list(params.get("strong", STRONG)), int(params.get("min_len", 3))
    return spread(col, lambda v: split_by(v, strong, min_len))


def taps(rows: DataFrame, r: RelationPlan, env: Env) -> list[DataFrame]:
    """What the learned operators of a relation count in the first pass: relation, tap, value, ord. They hand their input on as it is."""
    out = []
    col: Column = F.col("vals")

    def tap(name: str, c: Column) -> DataFrame:
        return rows.select("ord", c.alias("c")).select(F.lit(r.name).alias("relation"), F.lit(name).alias("tap"), F.explode("c").alias("value"), "ord")

    for name, params in filter(None, map(step, r.ops)):
        if name == "min_support":
            out.append(tap("support", col))
        elif name in LEARNED:
            out.append(tap("values", col))
        elif _evidence(name, params):
            out.append(tap("parts", strong_parts(col, params)))
        elif name == "match_learned":
            rows = rows.withColumn("vals", F.array().cast("array<string>"))
        else:
            rows = rows.withColumn("vals", apply(col, name, params, env).values)
    return out


@dataclass
class Learned:
    """Tables by relation; columns as in learn.py with relation as key."""

    canon: DataFrame
    prefix: DataFrame
    surname: DataFrame
    plural: DataFrame
    splits: DataFrame
    support: DataFrame
    counts: DataFrame


def learn_tables(counted: DataFrame, plan: Plan) -> Learned:
    """counted: relation, tap, value, n, first."""
    k = ["relation"]
    params: dict[str, dict[str, dict]] = {}
    for r in plan.relations:
        for name, p in filter(None, map(step, r.ops)):
            params.setdefault(name, {})[r.name] = p
    of = lambda name: F.col("relation").isin(list(params.get(name, {})))

    def per(name: str, build) -> DataFrame:
        """One table of all relations: those with equal parameters are built together."""
        groups: dict[str, tuple[dict, list[str]]] = {}
        for relation, p in params.get(name, {}).items():
            groups.setdefault(repr(sorted(p.items())), (p, []))[1].append(relation)
        made = [build(relations, p) for p, relations in groups.values()]
        return reduce(DataFrame.unionByName, made) if made else build([], {})

    values = counted.filter("tap = 'values'").select(*k, "value", "n", "first")
    tight = F.col("relation").isin([r for r, p in params.get("canon_by_freq", {}).items() if p.get("tight")])
    canon = materialize(learn.variant_map(values.filter(of("canon_by_freq")), k, tight), "canon")
    known = materialize(learn.recount(values, canon, k), "recount")
    mine = lambda rs: known.filter(F.col("relation").isin(rs))
    prefix = per("fold_by_prefix", lambda rs, p: learn.prefix_map(mine(rs), k, int(p.get("min_count", 3)), int(p.get("min_prefix_tokens", 1))))
    surname = per("fold_partial_names", lambda rs, p: learn.surname_map(mine(rs), k, int(p.get("min_count", 2))))
    keep = lambda p, key: [*(p.get(key) or []), *Env(plan.rules).rule(p.get(f"{key}_ref"), list)]
    plural = per("fold_plural", lambda rs, p: learn.plural_map(mine(rs), k, int(p.get("min_count", 1)), keep(p, "keep_distinct")))
    parts = counted.filter("tap = 'parts'").select(*k, "value", "n")
    splits = per(
        "split_smart",
        lambda rs, p: learn.weak_splits(parts.filter(F.col("relation").isin(rs)), k, list(p.get("weak", WEAK)), int(p.get("min_evidence", 3)), int(p.get("min_len", 3)), keep(p, "keep_whole")),
    )
    support = learn.recount(counted.filter("tap = 'support'").select(*k, "value", "n", "first"), canon, k)
    return Learned(canon, prefix, surname, plural, splits, support, known)


#: A row of the learned operators: its relation and product, and where the value stands.
KEY = ["of", *ROW]


def _gathered(rows: DataFrame, key: list[str]) -> DataFrame:
    """key, vals from key, pos, value; the values of one product and relation."""
    return rows.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("vals"))


def _replaced(x: DataFrame, name: str, params: dict, known: Learned) -> DataFrame:
    """One learned operator on rows of of (the relation), pid, ord, pos (array of int, for the order), value."""
    table = lambda t: t.withColumnRenamed("relation", "of")
    with_target = lambda y: y.select(*KEY, "pos", F.coalesce("target", "value").alias("value"))
    deeper = lambda y, parts: y.select(*KEY, "pos", F.posexplode(parts).alias("i", "value")).select(*KEY, F.concat("pos", F.array("i")).alias("pos"), "value")
    if name == "split_smart":
        parts = deeper(x, split_by(F.col("value"), list(params.get("strong", STRONG)), int(params.get("min_len", 3))))
        return deeper(parts.join(table(known.splits), ["of", "value"], "left"), F.coalesce("fragments", F.array("value")))
    if name == "fold_partial_names":
        single = F.when(~F.contains(F.trim("value"), F.lit(" ")), match_key(F.col("value")))
        return with_target(x.withColumn("k", single).join(table(known.surname), ["of", "k"], "left"))
    if name == "min_support":
        enough = table(known.support).filter(F.col("n") >= int(params.get("n", 2))).select("of", "value")
        return x.join(enough, ["of", "value"], "left_semi").select(*KEY, "pos", "value")
    learned = {"canon_by_freq": known.canon, "fold_by_prefix": known.prefix, "fold_plural": known.plural}[name]
    return with_target(x.join(table(learned), ["of", "value"], "left"))


def apply_learned(rows: DataFrame, steps_: list[tuple[str, dict]], known: Learned) -> DataFrame:
    """Neighbouring learned operators in the second pass, for all relations that have the same ones: rows (of, pid, ord, vals) are taken apart
    and put together once, and each learned table is joined once."""
    x = rows.select(*KEY, F.posexplode("vals").alias("pos", "value")).select(*KEY, F.array("pos").alias("pos"), "value")
    for name, params in steps_:
        x = _replaced(x, name, params, known)
    return _gathered(x, KEY)


class _Relation:
    """A relation on its way through the second pass."""

    def __init__(self, rows: DataFrame, plan: RelationPlan, env: Env):
        self.rows, self.plan, self.env = rows, plan, env  # rows: pid, ord, vals
        self.todo = list(filter(None, map(step, plan.ops)))
        self.sides: list[DataFrame] = []
        self.taxonomy: list[DataFrame] = []

    def advance(self, known: Learned | None) -> list[tuple[str, dict]]:
        """Applies operators up to the next learned ones, which come back; none at the end of the pipeline."""
        while self.todo:
            learned: list[tuple[str, dict]] = []
            while self.todo and (self.todo[0][0] in LEARNED or _evidence(*self.todo[0])):
                learned.append(self.todo.pop(0))
            if learned and known is not None:
                return learned
            if self.todo:
                self._plain(*self.todo.pop(0), known)
        return []

    def _plain(self, name: str, params: dict, known: Learned | None) -> None:
        if name == "match_learned":
            if known is None:
                self.rows, self.todo = self.rows.limit(0), []
                return
            source = known.counts.filter(F.col("relation") == str(params.get("learn_from") or self.plan.name)).drop("relation")
            terms = learn.vocabulary(source, [], int(params.get("min_count", 3)), int(params.get("max_len", 40)))
            text = self.rows.select(*ROW, F.array_join("vals", " ; ").alias("text"))
            self.rows = _gathered(learn.find_vocabulary(text, [], terms, ROW, max_terms=int(params.get("max_terms", 2))), ROW)
            return
        got = apply(F.col("vals"), name, params, self.env)
        if got.sides is not None:
            self.sides.append(self.rows.select(*ROW, got.sides.alias("s")).select(*ROW, F.explode("s").alias("s")).select(*ROW, "s.relation", "s.value"))
        if got.taxonomy is not None:
            self.taxonomy.append(self.rows.select(got.taxonomy.alias("t")).select(F.explode("t").alias("t")).select("t.parent", "t.relation", "t.child"))
        self.rows = self.rows.withColumn("vals", got.values)


def second_pass(relations: list[_Relation], known: Learned | None) -> DataFrame:
    """of, pid, ord, vals: the final values of all relations. Those whose next learned operators are the same go through them together, so
    the plan grows with the different pipelines of learned operators, not with the relations."""
    done: list[DataFrame] = []
    waiting = relations
    while waiting:
        groups: dict[str, tuple[list, list[_Relation]]] = {}
        for r in waiting:
            if segment := r.advance(known):
                key = repr([(n, sorted(p.items(), key=repr)) for n, p in segment])
                groups.setdefault(key, (segment, []))[1].append(r)
            else:
                done.append(r.rows.select(F.lit(r.plan.name).alias("of"), *ROW, "vals"))
        waiting = []
        for segment, members in groups.values():
            out = apply_learned(reduce(DataFrame.unionByName, [r.rows.select(F.lit(r.plan.name).alias("of"), *ROW, "vals") for r in members]), segment, known)
            more = [r for r in members if r.todo]
            if more:
                out = materialize(out, "applied", ["of"])
            ended = [r.plan.name for r in members if not r.todo]
            done.append(out.filter(F.col("of").isin(ended)) if more else out)
            for r in more:
                r.rows = out.filter(F.col("of") == r.plan.name).select(*ROW, "vals")
            waiting += more
    every = reduce(DataFrame.unionByName, done)
    return every.withColumn("vals", distinct_by(F.col("vals"), match_key)).filter(F.size("vals") > 0)


def with_fields(products: DataFrame, plan: Plan) -> DataFrame:
    """pid, ord, images, and one array of values for each field that titles and texts are made of; written once, read by several steps."""
    names = sorted({*_fields(plan.subject, ["title"]), *_fields(plan.text, ["title", "description"])})
    fields = F.create_map(*[x for f in names for x in (F.lit(f), from_sources(F.col("flat"), [f], True))])
    return materialize(products.select(*ROW, *[c for c in ["images"] if c in products.columns], fields.alias("fields")), "fields")


def _fields(spec: dict, default: list[str]) -> list[str]:
    return list(spec.get("fields") or ([spec["field"]] if spec.get("field") else default))


def subjects(products: DataFrame, spec: dict) -> DataFrame:
    """products with name: the first filled title field, cleaned and cut at a word."""
    from loomgraph.functions.text import py_clean

    most = int(spec.get("max_len", 200))
    given = [F.element_at("fields", F.lit(f)) for f in _fields(spec, ["title"])]
    first = F.coalesce(*[F.when(F.size(g) > 0, g) for g in given])
    products = products.withColumn("name", python_each(first, py_clean))
    s = F.btrim(collapse(F.array_join("name", " ")), F.lit(" -|·•,;"))
    cut = F.regexp_replace(F.left(s, F.lit(most)), r"\s\S*$", "")
    return products.withColumn("name", F.nullif(F.when(F.length(s) > most, F.regexp_replace(cut, r"[ ,;\-]+$", "")).otherwise(s), F.lit("")))


def texts(products: DataFrame, spec: dict) -> DataFrame:
    """pid, text."""
    from loomgraph.functions.text import py_clean

    most, least = int(spec.get("max_chars", 4000)), int(spec.get("min_chars", 1))
    fields = _fields(spec, ["title", "description"])
    products = products.select("pid", *[python_each(F.element_at("fields", F.lit(f)), py_clean).alias(f"f{i}") for i, f in enumerate(fields)])
    t = collapse(F.concat_ws(spec.get("separator", " . "), *[F.nullif(collapse(F.array_join(f"f{i}", " ")), F.lit("")) for i in range(len(fields))]))
    t = F.when(F.length(t) > most, F.regexp_replace(F.left(t, F.lit(most)), r"\s\S*$", "")).otherwise(t)
    return products.select("pid", t.alias("text")).filter(F.length("text") >= max(1, least))


#: Pictures that stand for a missing one (fixed values).
PLACEHOLDER_IMAGES = [r"/images/G/\d+/digital/video/web/Default_Background_Art", r"/no[-_]?image[-_]?available", r"/images/G/\d+/x-locale/common/transparent-pixel", r"/placeholder\.(?:jpg|png|gif)"]


def images(products: DataFrame, spec: dict) -> DataFrame:
    """pid, variant, url from a column images (array of maps): MAIN first, the first usable address of each in the order of preference."""
    prefer = spec.get("prefer", ["hi_res", "large", "thumb"])
    patterns = spec.get("exclude_patterns", PLACEHOLDER_IMAGES)
    usable = lambda u: F.startswith(u, F.lit("http")) & (~u.rlike("(?i)" + "|".join(patterns)) if patterns else F.lit(True))
    main = lambda m: F.coalesce(F.upper(F.try_element_at(m, F.lit("variant"))), F.lit("")) == "MAIN"
    ordered = F.concat(F.filter("images", main), F.filter("images", lambda m: ~main(m)))
    address = lambda m: F.get(F.filter(F.array(*[F.try_element_at(m, F.lit(k)) for k in prefer]), lambda u: u.isNotNull() & usable(u)), F.lit(0))
    found = F.filter(F.transform(ordered, lambda m: F.struct(F.coalesce(F.try_element_at(m, F.lit("variant")), F.lit("IMG")).alias("variant"), address(m).alias("url"))), lambda s: s["url"].isNotNull())
    found = F.slice(found, 1, 1) if spec.get("main_only", True) else found
    return products.select("pid", F.explode(found).alias("i")).select("pid", "i.variant", "i.url")


def between_relations(triples: DataFrame, plan: Plan) -> DataFrame:
    """Fallbacks first (a stand-in takes the name of its target where the product has none), then generic values that a specific relation has too go."""
    fallback = {r.name: r.fallback_for for r in plan.relations if r.fallback_for}
    if fallback:
        target = F.create_map(*[x for kv in fallback.items() for x in map(F.lit, kv)])
        stand_in = triples.filter(F.col("relation").isin(list(fallback))).withColumn("relation", F.try_element_at(target, F.col("relation")))
        own = triples.filter(~F.col("relation").isin(list(fallback)))
        has = own.filter(F.col("relation").isin(list(set(fallback.values())))).select("pid", "relation").distinct()
        triples = own.unionByName(stand_in.join(has, ["pid", "relation"], "left_anti"))
    for r in plan.relations:
        if r.subsumed_by:
            specific = triples.filter(F.col("relation").isin(r.subsumed_by)).select("pid", match_key(F.col("value")).alias("k"), F.lit(r.name).alias("relation")).distinct()
            triples = triples.withColumn("k", match_key(F.col("value"))).join(specific, ["pid", "relation", "k"], "left_anti").drop("k")
    return triples


def unique_triples(triples: DataFrame) -> DataFrame:
    """The first triple of each product, relation and comparison key."""
    rest = [c for c in triples.columns if c not in ("pid", "relation")]
    one = F.min_by(F.struct(*rest), F.struct("at", "value")).alias("one")  # partial minima: a product of many repeats costs a row a task
    firsts = triples.groupBy("pid", "relation", match_key(F.col("value")).alias("k")).agg(one)
    return firsts.select("pid", "relation", *[F.col(f"one.{c}").alias(c) for c in rest]).select(*triples.columns)


def homonyms(products: DataFrame) -> DataFrame:
    """name, n_homonyms over all products."""
    return products.filter("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("n_homonyms"))


def disambiguated(products: DataFrame, mode: str | bool) -> DataFrame:
    """products with subject: ``name ##pid`` always, only where the name is shared (true), or never (false); n_homonyms as counted."""
    counted = products.join(homonyms(products), "name", "left")
    marked = F.concat("name", F.lit(" ##"), "pid")
    subject = marked if mode == "always" else F.when(F.col("n_homonyms") > 1, marked).otherwise(F.col("name")) if mode in (True, "true") else F.col("name")
    return counted.withColumn("subject", subject)


@dataclass
class Graph:
    kg: DataFrame  # pid, subject, relation, value
    link: DataFrame  # subject, product_id, n_homonyms, product_name
    text: DataFrame  # product_id, text
    image: DataFrame  # product_id, variant, url
    taxonomy: DataFrame  # parent, relation, child
    learned: Learned | None


def build(products: DataFrame, plan: Plan, single_pass: bool = False) -> Graph:
    """products: pid, ord (order of reading), flat, and images where pictures are wanted.

    Products without an id are dropped, those without a title unless the plan keeps them, and those with fewer triples than
    min_relations (counted before repeated ones go). All products, dropped ones too, take part in what is learned.
    """
    products = materialize(products.filter("pid IS NOT NULL AND pid <> ''"), "flat")  # every relation reads it
    known = None
    every_value = materialize(raw_values(products, plan.relations), "raw", ["of"])
    groups: dict[str, list[RelationPlan]] = {}
    for r in plan.relations:
        groups.setdefault(repr(r.pre_ops), []).append(r)
    cleaned = [
        steps(every_value.filter(F.col("of").isin([r.name for r in rs])), "vals", rs[0].pre_ops, plan.env(rs[0].name)).filter(F.size("vals") > 0) for rs in groups.values()
    ]  # relations with the same preparation are prepared together, once for both passes
    every_value = materialize(reduce(DataFrame.unionByName, cleaned), "cleaned", ["of"])
    raw = {r.name: every_value.filter(F.col("of") == r.name).drop("of") for r in plan.relations}
    if plan.two_passes and not single_pass:
        counted = [t for r in plan.relations for t in taps(raw[r.name], r, plan.env(r.name))]
        counts = learn.counts(reduce(DataFrame.unionByName, counted), ["relation", "tap"], order="ord")
        known = learn_tables(materialize(counts, "counts"), plan)
    on_the_way = [_Relation(raw[r.name], r, plan.env(r.name)) for r in plan.relations]
    values = second_pass(on_the_way, known)
    number = F.create_map(*[x for i, r in enumerate(plan.relations) for x in (F.lit(r.name), F.lit(i))])
    at = lambda relation, pos: F.struct(F.try_element_at(number, relation).alias("relation_no"), pos.alias("pos"))
    triples = [values.select("of", "pid", F.posexplode("vals").alias("pos", "value")).select("pid", F.col("of").alias("relation"), "value", at(F.col("of"), F.col("pos")).alias("at"))]
    for r in on_the_way:
        triples += [s.select("pid", "relation", "value", at(F.lit(r.plan.name), F.lit(1 << 20)).alias("at")).distinct() for s in r.sides]
    taxonomy = [t for r in on_the_way for t in r.taxonomy]
    every = between_relations(reduce(DataFrame.unionByName, triples), plan)
    named = disambiguated(subjects(with_fields(products, plan), plan.subject), plan.subject.get("disambiguate", "always"))
    if plan.drop_without_subject:
        named = named.filter("name IS NOT NULL")
    enough = every.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= plan.min_relations) if plan.min_relations else None
    kept = named.join(enough.select("pid"), "pid", "left_semi") if enough is not None else named
    kg = unique_triples(every).join(kept.select("pid", "subject"), "pid").select("pid", "subject", "relation", "value")
    link = kept.select("subject", F.col("pid").alias("product_id"), "n_homonyms", F.col("name").alias("product_name"))
    text = texts(kept, plan.text).withColumnRenamed("pid", "product_id")
    image = images(kept, plan.image).withColumnRenamed("pid", "product_id") if "images" in products.columns else kept.select(F.col("pid").alias("product_id"), F.lit(None).cast("string").alias("variant"), F.lit(None).cast("string").alias("url")).limit(0)
    edges = reduce(DataFrame.unionByName, taxonomy).distinct() if taxonomy else kg.select(F.col("subject").alias("parent"), "relation", F.col("value").alias("child")).limit(0)
    return Graph(kg, link, text, image, edges, known)


def report(graph: Graph, raw: DataFrame | None = None) -> DataFrame:
    """relation, triples, distinct_values, distinct_keys, and with raw (relation, value as read) distinct_raw and the reduction in per cent."""
    out = graph.kg.groupBy("relation").agg(F.count(F.lit(1)).alias("triples"), F.count_distinct("value").alias("distinct_values"), F.count_distinct(match_key(F.col("value"))).alias("distinct_keys"))
    if raw is None:
        return out
    before = raw.groupBy("relation").agg(F.count_distinct("value").alias("distinct_raw"))
    return out.join(before, "relation", "left").withColumn("reduction", F.round(100 * (F.col("distinct_raw") - F.col("distinct_values")) / F.col("distinct_raw"), 1))


def operator_statistics(products: DataFrame, plan: Plan) -> DataFrame:
    """relation, step, op, rows_in, values_in, rows_out, values_out of each operator in the first pass (learned ones hand their input on)."""
    products = products.filter("pid IS NOT NULL AND pid <> ''")
    counted = []
    every = materialize(raw_values(products, plan.relations), "raw", ["of"])
    for r in plan.relations:
        rows = every.filter(F.col("of") == r.name)
        for i, (name, params) in enumerate(filter(None, map(step, r.pipeline))):
            if name in LEARNED or name == "match_learned" or _evidence(name, params):
                continue
            before = rows
            rows = rows.withColumn("vals", apply(F.col("vals"), name, params, plan.env(r.name)).values)
            sums = lambda df, s: df.agg(F.count_if(F.size("vals") > 0).alias(f"rows_{s}"), F.coalesce(F.sum(F.size("vals")), F.lit(0)).alias(f"values_{s}"))
            counted.append(sums(before, "in").crossJoin(sums(rows, "out")).select(F.lit(r.name).alias("relation"), F.lit(i).alias("step"), F.lit(name).alias("op"), "rows_in", "values_in", "rows_out", "values_out"))  # one row each
    return reduce(DataFrame.unionByName, counted)


def summary(graph: Graph, plan: Plan) -> dict:
    """What a run says about a category: products, triples, texts, pictures, edges, and per relation its figures and sources."""
    n = graph.link.count()
    triples = graph.kg.count()
    sources = {r.name: r.sources for r in plan.relations}
    relations = {r.relation: {"triples": r.triples, "distinct_values": r.distinct_values, "sources": sources.get(r.relation, ["derived"])} for r in report(graph).collect()}  # one row per relation
    return {
        "category": plan.category, "two_passes": plan.two_passes, "products": n, "triples": triples, "triples_per_product": round(triples / n, 2) if n else 0, "texts": graph.text.count(),
        "images": graph.image.count(), "taxonomy_edges": graph.taxonomy.count(), "relations": relations,
    }


def write_tables(known: Learned, path: str) -> None:
    """The learned tables as JSON lines, one folder each, so that a stream or a later run can apply them."""
    for name in ("canon", "prefix", "surname", "plural", "splits"):
        getattr(known, name).write.mode("overwrite").json(f"{path}/{name}")
