import zipfile

from pyspark.sql import functions as F

from loomgraph.functions import sql, text
from loomgraph.operators import links
from loomgraph.sources import archives, exports


def test_sql_functions(spark):
    assert "match_key" in sql.register(spark)
    samples = ["Café  Été", "ＡＢＣ ﬁ", "a b", "Łódź_x", "", "12,345.5 kg", "a/b c~d*"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    for r in df.select("v", text.match_key(F.col("v")).alias("a"), F.expr("match_key(v)").alias("b"), F.expr("tight_key(v)").alias("t"), F.expr("percent_encode(v)").alias("p"), F.expr("number_in(v)").alias("n")).collect():
        assert r.a == r.b and r.t == r.a.replace(" ", "")
    assert df.select(F.expr("number_in(v)")).filter("v = '12,345.5 kg'").first()[0] == 12345.5
    assert df.filter("v = 'a/b c~d*'").select(F.expr("percent_encode(v)")).first()[0] == "a%2Fb%20c~d%2A"


def test_archives(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.jsonl").write_text('{"x": 1}\n{"x": 2}\n')
    (src / "b.txt").write_text("no\n")
    names = archives.archive_folder(str(src), str(tmp_path / "inner.zip"))
    assert names == ["a.jsonl", "b.txt"] and (tmp_path / "inner.zip.ok").exists()
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.write(tmp_path / "inner.zip", "deep/inner.zip")
    got = archives.read_zip_lines(spark, str(tmp_path / "outer.zip"), ".jsonl").collect()
    assert [(r.member, r.value) for r in got] == [("outer.zip/deep/inner.zip/a.jsonl", '{"x": 1}'), ("outer.zip/deep/inner.zip/a.jsonl", '{"x": 2}')]
    archives.archive_folder(str(src), str(tmp_path / "again.zip"), delete=True)
    assert not list(src.iterdir())


def test_links(spark):
    df = spark.createDataFrame([("A", f"http://x/{i}") for i in range(10)] + [("B", None)], "variant string, url string")
    got = links.dead_links(df, "variant", 4, probe=lambda u: 404 if u[-1] in "02468" else 200, per_second=10_000).collect()
    assert [(r.variant, r.asked) for r in got] == [("A", 4)] and 0 <= got[0].low <= got[0].share <= got[0].high <= 1

    def fetch(u):
        if u.endswith("1"):
            raise ValueError("gone")
        return b"img"

    done = spark.createDataFrame([("http://x/2",)], "url string")
    rows = {r.url: r for r in links.fetched(df, fetch, done).collect()}
    assert len(rows) == 9 and rows["http://x/1"].error == "ValueError: gone" and rows["http://x/3"].content == b"img"


def test_latex_and_subset(spark):
    pairs = spark.createDataFrame([("A", "B", 0.5), ("A", "C_d", 0.25)], "category_a string, category_b string, jaccard double")
    assert exports.latex_half_matrix(pairs, "jaccard", ["A", "B", "C_d"], "{:.0f}", 1000) == "A & 500 & 250 \\\\\nB &  & -- \\\\"
    t = spark.createDataFrame([("1",), ("2",), ("3",)], "product_id string")
    now = spark.createDataFrame([("1", 0, "n"), ("1", 1, "later"), ("9", 2, "n")], "product_id string, row int, title string")
    old = spark.createDataFrame([("1", 0, "o", 1), ("2", 1, "o", 2)], "product_id string, row int, title string, extra int")
    got = {r.product_id: (r.title, r.extra) for r in exports.external_subset(t, now, old).collect()}
    assert got == {"1": ("n", None), "2": ("o", 2)}
