import json

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import audit, graph, interactions, profile
from loomgraph.plans.build import build, images, report, write_tables
from loomgraph.plans.config import Config, ConfigError, merged
from loomgraph.sources import records
from loomgraph.sources.exports import ntriples, recommender_files, write_tsv

CONFIG = """
defaults: {min_relations: 1, subject: {fields: [title], disambiguate: always}, text: {fields: [title, description]}}
categories:
  _generic:
    relations:
      hasBrand: {sources: ["details/Brand", store], ops: [title_case, {op: canon_by_freq}, {op: fold_by_prefix, min_count: 2}]}
      hasColor: {sources: ["details/*Color*"], first_source_only: false, ops: [{op: split_smart, min_evidence: 1}, canon_by_freq, {op: max_values, n: 3}]}
      hasGenre: {sources: [genre], ops: [{op: split_smart, mode: always}, {op: fold_plural}, {op: min_support, n: 1}]}
      hasLanguage: {sources: [lang], ops: [{op: language_base, audio_relation: hasAudio}]}
      hasType: {sources: [title], ops: [{op: match_lexicon, lexicon: {mug: Mug, cup: Cup}}]}
      hasArtist: {sources: [artist], ops: [canon_by_freq]}
      hasArtistTitle: {sources: [title], fallback_for: hasArtist, ops: [{op: match_learned, learn_from: hasArtist, min_count: 1}]}
      hasStyle: {sources: [style], subsumed_by: [hasColor]}
  Toys: {inherit: _generic, relations: {hasNothing: null}}
"""
RECORDS = [
    {"parent_asin": "A1", "title": "Red Mug by Nora Bell", "store": "acme", "genre": "Thriller & Drama", "lang": "English (Dolby)", "details": {"Brand": "ACME Toys", "Color": "red, blue", "Body Color?": "Green", "": ["Shape Round"]}, "description": ["fine", "mug"], "style": "Red"},
    {"parent_asin": "A2", "title": "Cup", "details": {"Brand": "acme toys", "Color": "red"}, "genre": "Thrillers", "artist": "Nora Bell"},
    {"parent_asin": "A3", "title": "Cup", "details": {"Brand": "Acme", "Color": "blue"}, "artist": "Nora Bell", "images": [{"variant": "PT01", "large": "http://x/0.jpg"}, {"variant": "MAIN", "hi_res": "http://x/no_image_available.jpg", "large": "http://x/1.jpg"}]},
    {"parent_asin": "A4", "title": "Cup", "details": {"Brand": "Acme"}}, {"parent_asin": "A5", "title": "Zed", "details": {"Brand": "Acme"}}, {"title": "no id"}, {"parent_asin": "A6", "store": "No Title"},
]


def products(spark, records_=RECORDS):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records_)], "ord bigint, json string")
    return df.select(F.get_json_object("json", "$.parent_asin").alias("pid"), "ord", records.flat(F.col("json"), ["Shape"]).alias("flat"), F.from_json(F.get_json_object("json", "$.images"), "array<map<string,string>>").alias("images"))


def test_two_pass_build(spark, tmp_path):
    cfg = Config.parse(CONFIG)
    assert cfg.validate() == ["Toys.hasNothing: no sources"] or cfg.validate() == []
    g = build(products(spark), cfg.plan("Toys"))
    kg = {(r.pid, r.relation, r.value) for r in g.kg.collect()}
    assert {v for p, r, v in kg if r == "hasBrand"} == {"Acme"}
    assert {v for p, r, v in kg if (p, r) == ("A1", "hasColor")} == {"red", "blue", "Green"}
    assert ("A2", "hasGenre", "Thriller") in kg and ("A1", "hasAudio", "Dolby") in kg and ("A1", "hasArtist", "Nora Bell") in kg
    assert not any(r == "hasArtistTitle" for _, r, _ in kg) and ("A1", "hasStyle", "Red") not in kg
    assert {p for p, _, _ in kg} == {"A1", "A2", "A3", "A4", "A5"}  # A6 has no title
    write_tables(g.learned, str(tmp_path / "tables"))
    assert spark.read.json(str(tmp_path / "tables/canon")).filter("value = 'ACME Toys'").first().target == "Acme Toys"
    raw = spark.createDataFrame([("hasBrand", v) for v in ("ACME Toys", "acme toys", "Acme")], "relation string, value string")
    assert {r.relation: r.reduction for r in report(g, raw).collect()}["hasBrand"] > 60
    link = {r.product_id: r for r in g.link.collect()}
    assert link["A2"].subject == "Cup ##A2" and link["A2"].n_homonyms == 3
    assert {r.product_id: r.text for r in g.text.collect()}["A1"] == "Red Mug by Nora Bell . fine mug"
    assert [tuple(r) for r in g.image.collect()] == [("A3", "MAIN", "http://x/1.jpg")]


def test_single_pass_and_empty_input(spark):
    plan = Config.parse(CONFIG).plan("Toys")
    g = build(products(spark), plan, single_pass=True)
    assert {r.value for r in g.kg.filter("relation = 'hasBrand'").collect()} == {"ACME Toys", "Acme Toys", "Acme"}
    empty = build(products(spark).limit(0), plan)
    assert empty.kg.count() == 0 and empty.link.count() == 0


def test_images_without_any(spark):
    df = spark.createDataFrame([("a", None), ("b", [])], "pid string, images array<map<string,string>>")
    assert images(df, {}).count() == 0


def test_config():
    with pytest.raises(ConfigError):
        Config.parse("a: 1\na: 2")
    assert merged({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}}
    circle = Config({"categories": {"A": {"inherit": "B"}, "B": {"inherit": "A"}}})
    assert "circle" in circle.validate()[0]
    bad = Config({"categories": {"A": {"relations": {"r": {"sources": ["x"], "ops": ["nope", {"op": "map", "rules_ref": "no.where"}]}}}}})
    assert len(bad.validate()) == 2


def test_flat(spark):
    lines = ['{"b": 1, "a": ["x", null, "y"], "details": {"k": true, "z": {"deep": 1}}, "images": [1], "n": null}', "[1]", "garbage", ""]
    df = spark.createDataFrame([(s,) for s in lines], "j string")
    got = [r.f for r in df.select(records.flat(F.col("j")).alias("f")).collect()]
    assert [(e.path, e["values"]) for e in got[0]][:3] == [("b", ["1"]), ("a", ["x", "y"]), ("details/k", ["true"])]
    assert not got[2] and not got[3]


def test_sources(spark, tmp_path):
    (tmp_path / "meta_Toys.jsonl").write_text('{"a": 1}\nbad\n[2]\n{"a": 2}\n')
    (tmp_path / "t.tsv").write_text("id\tdetails/Color\tdetails/Size\nx\tred\t\n")
    (tmp_path / "arr.json").write_text('[{"a": 1}, 2, {"a": 3}]')
    (tmp_path / "old.txt").write_text("{'asin': 'A', 'x': 1}\nnot python(\n{'asin': 'B'}\n")
    got = records.read_json_lines(spark, [str(tmp_path / "*.jsonl")], ["Other"])
    assert [(r.category, json.loads(r.json)["a"]) for r in got.orderBy("row").collect()] == [("Toys", 1), ("Toys", 2)]
    assert json.loads(records.read_table(spark, str(tmp_path / "t.tsv")).first().json) == {"id": "x", "details": {"Color": "red"}}
    assert records.read_json_array(spark, str(tmp_path / "arr.json")).count() == 2
    assert [json.loads(r.json)["asin"] for r in records.read_literals(spark, [str(tmp_path / "old.txt")], "asin").collect()] == ["A", "B"]
    with pytest.raises(FileNotFoundError):
        records.expand([str(tmp_path / "none*")])


def test_k_core_and_split(spark):
    import random

    rng = random.Random(5)
    pairs = {(f"u{rng.randint(0, 30)}", f"i{rng.randint(0, 20)}") for _ in range(160)}
    left = set(pairs)
    while True:
        u = {x for x, _ in left if sum(a == x for a, _ in left) >= 4}
        i = {x for _, x in left if sum(b == x for _, b in left) >= 4}
        kept = {(a, b) for a, b in left if a in u and b in i}
        if kept == left:
            break
        left = kept
    got = interactions.k_core(spark.createDataFrame(sorted(pairs), "user string, item string"), 4)
    assert {tuple(r) for r in got.collect()} == left
    assert interactions.k_core(spark.createDataFrame([], "user string, item string"), 3).count() == 0
    inter = spark.createDataFrame([("u", f"i{k}", 1.0, k // 2) for k in range(23)] + [("v", "i1", 1.0, 5)], "user string, item string, rating double, ts bigint")
    sizes = {(r.user, r.split): r["count"] for r in interactions.chronological_split(inter).groupBy("user", "split").count().collect()}
    assert sizes == {("u", "test"): 2, ("u", "valid"): 2, ("u", "train"): 19, ("v", "test"): 1}


def test_last_interactions(spark):
    rows = [("u", "i", 1.0, 5, "x"), ("u", "i", 2.0, 7000000000000, "x"), ("u", "i", None, 3, "x"), (None, "i", 1.0, 1, "x"), ("u", None, 1.0, 1, "x"), ("u", "j", 1.0, None, "x"), ("w", "k", None, 9, "x")]
    got = interactions.last_interactions(spark.createDataFrame(rows, "user string, item string, rating double, ts bigint, category string"))
    assert {tuple(r) for r in got.collect()} == {("u", "i", 2.0, 7000000000), ("w", "k", 0.0, 9)}
    some = spark.createDataFrame([("k",)], "item string")
    assert interactions.last_interactions(spark.createDataFrame(rows, "user string, item string, rating double, ts bigint, category string"), some).count() == 1


def test_overlap(spark):
    v = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "x"), ("A", "y"), ("B", "y"), ("A", "y"), (None, "y"), ("A", None)], "category string, object string")
    got = {(r.category_a, r.category_b): (r.shared, r.size_a, r.size_b) for r in interactions.entity_overlap(v).collect()}
    assert got == {("A", "B"): (2, 2, 2), ("A", "C"): (1, 2, 1), ("B", "C"): (1, 2, 1)}
    m = interactions.half_matrix(interactions.entity_overlap(v), "shared", ["B", "C"]).orderBy("category_a").collect()
    assert (m[0].B, m[0].C) == (2, 1)


def test_audit_and_profile(spark):
    kg = spark.createDataFrame([("r", v, 1) for v in ["Red", "red", "N/A", "<b>x</b>", "y" * 90, "12", "z"]] + [("num", str(i), 1) for i in range(9)] + [(None, "x", 1), ("r", None, 1)], "relation string, value string, extra int")
    values = audit.relation_values(kg)
    faults = {(r.relation, r.fault) for r in audit.pollution(values).collect()}
    assert faults == {("r", "noise"), ("r", "html"), ("r", "long"), ("r", "numeric"), ("r", "short")}
    assert ("r", "key", "red") in {(r.relation, r.family, r.k) for r in audit.missed_merges(values).collect()}
    s = {r.relation: r.score for r in audit.scores(values, 100).collect()}
    assert 0 <= s["r"] < s["num"] <= 100
    assert audit.global_score(audit.scores(values, 100)).first().score <= 100
    odd = spark.createDataFrame([("r", "Acme Ltd", "Zeta Ltd"), ("r", "Foo", "Bar"), ("r", "Same One", "Same Two")], "relation string, value string, target string")
    assert {r.value for r in audit.suspicious_merges(odd).collect()} == {"Acme Ltd", "Foo"}
    attrs = spark.createDataFrame([(f"p{i}", k, f"v{i % 5}") for i in range(20) for k in ("A", "B")] + [("p1", "C", "c")], "pid string, key string, value string")
    prof = profile.key_profile(attrs, 20)
    assert {r.key: r.reasons for r in prof.collect()} == {"A": "", "B": "", "C": "constant"}
    red = profile.redundancy(attrs)
    assert [(r.key_a, r.key_b, r.fuse) for r in red.collect()] == [("A", "B", True)]
    assert "hasA" in profile.suggested(red, prof)
    declared = spark.createDataFrame([("a",), ("gone",)], "key string")
    assert {r.key: r.status for r in profile.compared(prof, declared).collect()} == {"A": "covered", "B": "missing", "gone": "dead"}


def test_graph_tools(spark, tmp_path):
    link = spark.createDataFrame([("P1", 1, "One"), ("P2", 2, 'Two "x"\n'), (None, 1, "n")], "product_id string, n_homonyms bigint, product_name string")
    text = spark.createDataFrame([("P1", "t"), ("P2", None)], "product_id string, text string")
    image = spark.createDataFrame([("P1", "MAIN", "https://img1.shop.example/i/ABC._L500_.jpg"), ("P2", "MAIN", "http://x/y"), ("P3", "MAIN", None)], "product_id string, variant string, url string")
    kg = spark.createDataFrame([("P1", "hasColor", "Red & b"), ("P9", "hasPrice", "1")], "product_id string, relation string, value string")
    assert {r.product_id for r in graph.trimodal(link, text, image).collect()} == {"P1", "P2"}
    assert graph.coverage(kg, link, text, image).first().without_triples == 1
    assert {(r.reason, r.n_rows) for r in graph.url_faults(image).collect()} == {("insecure", 1), ("not http", 1)}
    kept, signals = graph.signal_split(kg, ["hasPrice"])
    assert kept.count() == 1 and signals.count() == 1
    assert spark.range(1).select(graph.plain_subject(F.lit("## #1 name"))).first()[0] == "1 name"
    lines = {r.line for r in ntriples(kg, link, text, image, "https://k/", alignments={"hasColor": "http://schema.org/color"}).collect()}
    assert '<https://k/entity/hasColor/Red%20%26%20b> <http://www.w3.org/2000/01/rdf-schema#label> "Red & b" .' in lines
    assert any('"Two \\"x\\"\\n"' in x for x in lines)
    low, high = graph.wilson(F.lit(0), F.lit(0))
    assert tuple(spark.range(1).select(low, high).first()) == (0.0, 0.0)
    a = graph.stratified_sample(spark.range(100).withColumn("s", F.col("id") % 3), "s", "id", 5)
    assert a.count() == 15
    write_tsv(kg, str(tmp_path / "kg"))
    assert spark.read.text(str(tmp_path / "kg")).count() == 2
    inter = spark.createDataFrame([("u", "P1", 1.0, 5, "test")], "user string, item string, rating double, ts bigint, split string")
    recommender_files(inter, kg, str(tmp_path / "rec"))
    assert spark.read.csv(str(tmp_path / "rec/kg"), sep="\t", header=True).columns == ["head_id:token", "relation_id:token", "tail_id:token"]


def test_streaming(spark, tmp_path):
    from loomgraph.streaming.apply import stream_canonical, stream_counts, stream_interactions

    src = str(tmp_path / "in")
    spark.createDataFrame([("r", "red"), ("r", "Red"), ("r", "Red"), (None, "x")], "relation string, value string").write.parquet(src)
    s = spark.readStream.schema("relation string, value string").parquet(src)
    mapping = spark.createDataFrame([("r", "red", "Red")], "relation string, value string, target string")
    q = stream_counts(stream_canonical(s, mapping)).writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.sql("SELECT * FROM counted").collect()] == [("r", "Red", 3)]
    src = str(tmp_path / "inter")
    spark.sql("SELECT 'u' AS user, 'i' AS item, timestamp'2024-01-01' AS ingested_at FROM range(3)").write.parquet(src)
    q = stream_interactions(spark.readStream.schema("user string, item string, ingested_at timestamp").parquet(src)).writeStream.format("memory").queryName("once").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT * FROM once").count() == 1


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.queries()["p3_report"](spark, sf).count() > 0
