import json

import pytest

from loomgraph.__main__ import main
from loomgraph.operators import profile
from loomgraph.plans.build import operator_statistics
from loomgraph.plans.config import Config
from loomgraph.sources import exports, graphs, records

CONFIG = """
defaults: {id_field: parent_asin, min_relations: 1, subject: {fields: [title], disambiguate: always}, text: {fields: [title], min_chars: 3}}
categories:
  Books:
    relations:
      hasColor: {sources: [details/Color], ops: [title_case, canon_by_freq]}
      hasPages: {sources: [details/Pages], ops: [{op: drop_values, values: [n/a]}]}
"""


def lines(n):
    for i in range(n):
        yield json.dumps({"parent_asin": f"P{i}", "title": f"# Mug {i}" if i % 2 else f"Mug {i}", "details": {"Color": ["red", "RED", "blue"][i % 3], "Colour name": ["red", "blue", "green", "black"][i % 4], "Pages": str(i % 5)}, "images": [{"variant": "MAIN", "hi_res": f"https://x/{i}.jpg"}] if i % 4 else []})


@pytest.fixture
def files(tmp_path):
    (tmp_path / "c.yaml").write_text(CONFIG)
    (tmp_path / "books.jsonl").write_text("\n".join(lines(40)) + "\nno record\n")
    return tmp_path


def test_build_finalise_and_summary(spark, files, capsys):
    out = f"file://{files}/out"
    assert main(["build", "--config", str(files / "c.yaml"), "--input", f"Books={files}/books.jsonl", "--out", out], spark) == 0
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert said["products"] == 40 and said["relations"]["hasColor"]["sources"] == ["details/Color"] and said["images"] == 30
    whole = json.loads(spark.read.text(f"{out}/build_summary").first()[0])
    assert whole["totals"]["products"] == 40 and whole["categories"][0] == said
    first = graphs.finalise(spark, f"{out}/Books").first().asDict()
    kg = lambda: sorted(map(tuple, spark.read.parquet(f"{out}/Books/trimodal/kg").collect()))
    once = kg()
    assert main(["finalise", f"{out}/Books"], spark) == 0 and kg() == once
    assert first == json.loads(capsys.readouterr().out) and first["after"] == 30 and first["retention"] == 0.75
    assert {r[1][:4] for r in once} == {"Mug "}


def test_limit_discover_compare_validate_list(spark, files, capsys):
    c, i = ["--config", str(files / "c.yaml")], f"Books={files}/books.jsonl"
    assert main(["build", *c, "--input", i, "--out", f"file://{files}/few", "--limit", "7"], spark) == 0
    assert json.loads(capsys.readouterr().out)["products"] == 7
    assert main(["discover", "--input", i, "--sample", "30"], spark) == 0 and "hasColor" in capsys.readouterr().out
    assert main(["compare", *c, "--input", i], spark) == 0
    status = {r["key"]: r["status"] for r in map(json.loads, capsys.readouterr().out.splitlines())}
    assert status["details/Color"] == "covered" and status["details/Colour name"] == "missing"
    assert main(["list", *c]) == 0 and json.loads(capsys.readouterr().out) == {"category": "Books", "relations": 2, "two_passes": True}
    assert main(["validate", *c]) == 0
    (files / "bad.yaml").write_text(CONFIG.replace("title_case", "title_cas"))
    assert main(["validate", "--config", str(files / "bad.yaml")]) == 1


def test_aliases_macros_names_and_statistics(spark, files):
    report = Config({}, {"people": {"person_mappings": {"A B": "A C", "A C": "A B", "D E": "D F", "D F": "D G"}}, "x": {}}).alias_report()
    assert report == [{"rules": "people", "mappings": 4, "canonical": 2, "variants": 3, "chains": 3, "circles": 2}]
    assert exports.latex_macros({"pairMax": "A & B", "n": 12345, "j": 1.25}) == "\\newcommand{\\pairMax}{A \\& B}\n\\newcommand{\\n}{12{,}345}\n\\newcommand{\\j}{1.2}"
    v = ["red", "blue", "green", "black", "x", "y"]
    a = [("details/Frame Color", s) for s in v] + [("details/Color Frame", s) for s in ["red", "p", "q", "r", "s", "t"]] + [("A", s) for s in ["yes", "no", "true", "false"]] + [("B", s) for s in ["yes", "no", "true", "false"]]
    df = spark.createDataFrame([(str(i), k, s) for i, (k, s) in enumerate(a)], "pid string, key string, value string")
    assert [(r.key_a, r.key_b) for r in profile.redundancy(df).collect()] == [("details/Color Frame", "details/Frame Color")]
    known = {r.key: r.bad for r in spark.createDataFrame([("details/ISBN 13",), ("author/avatar",), ("details/Color",)], "key string").withColumn("bad", profile.unwanted(__import__("pyspark.sql.functions").sql.functions.col("key"))).collect()}
    assert known == {"details/ISBN 13": True, "author/avatar": True, "details/Color": False}
    from loomgraph.__main__ import _records

    stats = operator_statistics(_records(spark, f"{files}/books.jsonl", None, None, "parent_asin"), Config.parse(CONFIG).plan("Books"))
    got = {(r.relation, r.op): (r.rows_in, r.values_in, r.rows_out, r.values_out) for r in stats.collect()}
    assert got["hasColor", "title_case"] == (40, 40, 40, 40)
    with pytest.raises(ValueError):
        exports.write_report(spark.range(exports.REPORT_ROWS + 1), str(files / "r.json"))
    assert records.sampled(spark.range(50).withColumnRenamed("id", "row"), 10).count() == 10
