import random
import re

import pytest
from pyspark.sql import functions as F

from loomgraph.common import components
from loomgraph.operators import learn

C = "value string, n bigint, first bigint"


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_variant_map_ties(spark):
    c = spark.createDataFrame([("Red", 3, 0), ("red", 3, 1), ("RED", 1, 2), ("Café", 1, 3), ("Cafe", 1, 4), ("solo", 9, 5), ("--", 4, 6)], C)
    assert rows(learn.variant_map(c, [])) == {("Red", "red"), ("RED", "red"), ("Cafe", "Café")}
    tight = spark.createDataFrame([("J. K. R", 5, 0), ("JK R", 1, 1)], C)
    assert rows(learn.variant_map(tight, [], F.lit(True))) == {("JK R", "J. K. R")}


def test_prefix_map(spark):
    c = spark.createDataFrame([("Bloomsbury", 5, 0), ("Bloomsbury Publishing PLC", 3, 1), ("Penguin Books", 9, 2), ("Penguin", 2, 3), ("", 5, 4)], C)
    assert rows(learn.prefix_map(c, [], 3)) == {("Bloomsbury Publishing PLC", "Bloomsbury")}


def test_surname_map(spark):
    c = spark.createDataFrame([("J.K. Rowling", 2, 0), ("Ann Lee", 3, 1), ("Bob Lee", 3, 2), ("John Smith Jr.", 2, 3), ("Rowling", 8, 4)], C)
    assert rows(learn.surname_map(c, [])) == {("rowling", "J.K. Rowling"), ("smith", "John Smith Jr.")}


def test_plural_map_chains_and_exceptions(spark):
    c = spark.createDataFrame([("Thriller", 5, 0), ("Thrillers", 2, 1), ("Glass", 4, 2), ("Glasses", 9, 3), ("Movies", 7, 4), ("Movie", 7, 5), ("lonely", 1, 6)], C)
    assert rows(learn.plural_map(c, [])) == {("Thrillers", "Thriller"), ("Movies", "Movie")}
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y")], "value string, target string")
    assert rows(learn.closed(chain, [])) == {("a", "d"), ("b", "d"), ("c", "d"), ("x", "y")}


def test_weak_splits(spark):
    parts = spark.createDataFrame(
        [("Action & Adventure", 4), ("Action", 5), ("Adventure", 3), ("Bath & Body Works", 9), ("Bath", 9), ("Johnson & Johnson", 9), ("Johnson", 9), ("Johnson, Johnson", 2), ("Simon & Action", 1), ("Simon", 2)], "value string, n bigint"
    )
    got = {r.value: r.fragments for r in learn.weak_splits(parts, [], keep_whole=["nothing"]).collect()}
    assert got == {"Action & Adventure": ["Action", "Adventure"], "Johnson, Johnson": ["Johnson", "Johnson"]}
    assert "Action & Adventure" not in {r.value for r in learn.weak_splits(parts, [], keep_whole=["action & ADVENTURE"]).collect()}


def test_vocabulary_in_text(spark):
    c = spark.createDataFrame([("Nora Bell", 3, 0), ("Nora Bell Band", 3, 1), ("Live", 9, 2), ("Rare Name", 1, 3)], C)
    terms = learn.vocabulary(c, [])
    texts = spark.createDataFrame([(1, "The Nora Bell Band live, norabell again; Nora Bell."), (2, ""), (3, None)], "id int, text string")
    got = [(r.id, r.pos, r.value) for r in learn.find_vocabulary(texts, [], terms, ["id"]).orderBy("id", "pos").collect()]
    assert got == [(1, 0, "Nora Bell Band"), (1, 1, "Nora Bell")]


def test_runs_of_texts_are_not_broadcast(spark, tmp_path):
    """Spark takes the runs for as small as the file of texts that they come from."""
    path = str(tmp_path / "texts")
    spark.range(2000).select("id", F.concat(F.repeat(F.lit("one two three "), 20), F.lit("Nora Bell")).alias("text")).write.parquet(path)
    terms = learn.vocabulary(spark.createDataFrame([("Nora Bell", 3, 0), ("Long Name of Six Words here", 3, 1)], C), [])
    found = learn.find_vocabulary(spark.read.parquet(path), [], terms, ["id"])
    assert found.count() == 2000
    assert "BuildLeft" not in found._jdf.queryExecution().executedPlan().toString()


def _brute(text, forms, max_terms, max_words):
    words, out, i = re.findall("[a-z0-9]+", text.lower()), [], 0
    while i < len(words):
        n = next((n for n in range(min(max_words, len(words) - i), 0, -1) if " ".join(words[i : i + n]) in forms), 0)
        out += [forms[" ".join(words[i : i + n])]] if n else []
        i += n or 1
    return list(dict.fromkeys(out))[:max_terms]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_vocabulary_against_brute_force(spark, monkeypatch, most):
    """With the starts of terms broadcast and shuffled; keys of another type than the texts', terms that overlap, glued ones, a limit of words."""
    monkeypatch.setattr(learn, "BROADCAST_STARTS", most)
    draw = random.Random(5)
    some = lambda n: " ".join(draw.choice("ab cd ef gh ij".split()) for _ in range(n))
    given = sorted({(k, some(draw.randint(2, 5))) for k in (1, 2) for _ in range(12)})
    terms = spark.createDataFrame([(k, t, t.title()) for k, t in given], "k bigint, term string, value string")
    texts = [(i, 1 + i % 3, some(draw.randint(0, 30)) + draw.choice([" abcd", " cdefgh.", "; IJ ab", " xx"]) + (" " + draw.choice(given)[1].replace(" ", ""))) for i in range(200)]
    texts += [(200, 1, ""), (201, 1, None), (202, None, given[0][1])]
    df = spark.createDataFrame(texts, "id int, k int, text string")
    for max_words in (None, 3):
        got = {}
        for r in learn.find_vocabulary(df, ["k"], terms, ["id"], max_terms=3, max_words=max_words).orderBy("id", "pos").collect():
            got.setdefault(r.id, []).append(r.value)
        want = {}
        for i, k, text in texts:
            forms = {}
            for key, t in given:
                for form in (t, t.replace(" ", "")):
                    if key == k:
                        forms[form] = min(forms.get(form, t.title()), t.title())
            if found := _brute(text or "", forms, 3, max_words or 5):
                want[i] = found
        assert got == want
    assert learn.find_vocabulary(df, ["k"], terms.limit(0), ["id"]).count() == 0


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(e).collect()}
    assert {got[i] for i in range(41)} == {0} and got[102] == 100
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
