import itertools
import random

import pytest

from loomgraph.llm import garble, markup

L = markup.Labeller()


def cut_value(weights, edges, side):
    inside = set(side)
    cost = sum(w for i, w in enumerate(weights) if w > 0 and i not in inside) - sum(w for i, w in enumerate(weights) if w < 0 and i in inside)
    return cost + sum(c for a, b, c in edges if (a in inside) != (b in inside))


def test_minimum_cut_equals_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 8)
        weights = [rng.choice([-2.0, -0.7, 0.4, 1.5, 3.0]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.3, 1.0, 2.0])) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        best = min(cut_value(weights, edges, s) for k in range(n + 1) for s in itertools.combinations(range(n), k))
        assert cut_value(weights, edges, markup.minimum_cut(weights, edges)) == pytest.approx(best)


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("<b>soft</b> lid", {"html"}), ("a &amp; b", {"html"}), ("&lt;i&gt;x&lt;/i&gt;", {"html"}), ("x<br/>y", {"html"}), ("<!-- slot 3 -->", {"html"}), ("print <your name> here", set()), ("R&D; tested", set()), ("a < b and c > 4", set()),
        ("**bold** text", {"markdown"}), ("~~old~~", {"markdown"}), ("[t](https://x.y/z)", {"markdown"}), ("__a b__ and `c`", {"markdown"}), ("Title\n=====\ntext", {"markdown"}), ("```\ncode\n```", {"markdown"}), ("## Head", {"markdown"}),
        ("| a | b |\n|---|---:|\n| c | 3 |", {"markdown"}), ("1. __a__\n2. plain", {"markdown"}), ("rated **** by two, *** by one", set()), ("5 * 3 * 2 = 30", set()), ("[good] (mostly)", set()), ("3_way and tag_no_4", set()), ("5_ and 10_ __ pick", set()), ("#1 choice", set()),
        ("[[a|b]]", {"wiki"}), ("{{convert|3|cm}}", {"wiki"}), ("'''a b''' c", {"wiki"}), ("== Head ==", {"wiki"}), ("{|\n|-\n| a || 3\n|}", {"wiki"}), ("7'' pocket and 3'' strap", set()), ("set {cup, lid}", set()),
        (r"\textbf{a}, b", {"latex"}), (r"area $A_{7} = 7\,\mathrm{cm}^2$", {"latex"}), (r"\begin{itemize}" + "\n\\item a\n" + r"\end{itemize}", {"latex"}), (r"in D:\item\list on", set()), ("from $5 to $10, $$ and $$$", set()), ("2^3 boxes", set()),
        ("", set()), ("   ", set()), ("plain", set()), ("- a\n- b", set()), ("> 30 degrees", set()), ("<p>x</p> **y** [[z]] " + r"\emph{q}", {"html", "markdown", "wiki", "latex"}),
    ],
)
def test_kinds(text, kinds):
    assert set(L.label(text)) == kinds


def test_clean_keeps_structure():
    c = lambda t: markup.clean(t, L.label(t))
    assert c("<h2>Head</h2><ul><li>a</li><li>b &amp; c</li></ul><pre><code>x &lt; 1</code></pre><script>var q=1;</script>") == "## Head\n\n- a\n- b & c\n\n```\nx < 1\n```"
    assert c("Title\n=====\n**b** and `c` [t](https://x/y)\n\n> quoted") == "# Title\nb and c t\n\nquoted"
    assert c("== Head ==\n* ''a''\n** '''b'''\n[[Category:X]]\n{| class=x\n|-\n| a || 3\n|}") == "# Head\n- a\n  - b\n| a | 3 |"
    assert c("\\section{S}\n\\begin{itemize}\n\\item \\textbf{a}~\\cite{k}\n\\end{itemize}\n\\[ x = \\frac{a}{2} \\]") == "# S\n\n- a\n$x = \\frac{a}{2}$"


def test_residue(spark):
    rows = [(1, "<b>x</b>", "k"), (1, "<b>x</b>", "k"), (2, None, "k"), (3, "", "k"), (4, "plain & simple", "k"), (5, "a **b** <i>c</i>", "k"), (6, "word " * 20_000 + "<br>", "k")]
    df = spark.createDataFrame(rows, "row_id bigint, text string, kind string")
    got = sorted((r.row_id, r.kind) for r in markup.residue(df, ["row_id"]).collect())
    assert got == [(1, "html"), (1, "html"), (5, "html"), (5, "markdown"), (6, "html")]
    assert markup.residue(df.limit(0), ["row_id"]).count() == 0


def test_long_spans_and_tables_without_outer_pipes(spark):
    long = "word " * 600 + "end"
    for kind, spans in {"markdown": ("**{}**", "*{}*", "__{}__", "~~{}~~", "`{}`", "_{}_"), "wiki": ("[[{}]]", "'''{}'''", "''{}''"), "latex": (r"\({}\)", r"\[{}\]")}.items():
        for s in spans:
            assert kind in L.label("a " + s.format(long) + " b"), s
    assert L.label("a **b\n\nc** d") == {}
    df = spark.createDataFrame([(1, "a | b\n--- | ---\nc | d"), (2, "a | b")], "row_id bigint, text string")
    assert [(r.row_id, r.kind) for r in markup.residue(df, ["row_id"]).collect()] == [(1, "markdown")]


def misread(s, codec, times=1):
    for _ in range(times):
        s = "".join(garble.alphabet(codec)[b] for b in s.encode("utf-8"))
    return s


@pytest.mark.parametrize("codec,times", [("cp1252", 1), ("latin-1", 1), ("cp1250", 1), ("cp1251", 1), ("cp437", 1), ("mac_roman", 1), ("cp1252", 2)])
def test_round_trip_of_readings(codec, times):
    r = garble.Restorer([f"utf-8>{codec}"])
    for clean in ("größere Küche für 5 €", "l’été à Besançon", "“Worth it,” naïve", "за 30 дней ёлка", "小さい水筒です。", "👍🏽 ok"):
        assert r.restore(misread(clean, codec, times)) == (clean, True)
        assert r.restore(clean) == (clean, False)


def test_other_readings():
    assert garble.Restorer(["cp1251>cp1252"]).restore("ìîäåëü Saffron, äíåé è çà") == ("модель Saffron, дней и за", True)
    assert garble.Restorer([]).restore("この水筒は手洗いしてください。".encode("cp932").decode("cp1252", "replace").replace("�", "\x81"))[1]
    plain = "AÇÃO VERÃO L’ÂGE GRÁTIS été PROTEÇÃO São Łódź À l’usage"
    assert garble.Restorer(["utf-8>cp1252", "utf-8>latin-1", "cp1251>cp1252", "utf-8>mac_roman"]).restore(plain) == (plain, False)


def test_control_characters_that_stay_are_garbled():
    for text in ("a\x93b\x94 c", "\x82", "caf\x8e"):
        assert garble.Restorer([]).restore(text) == (text, True)
    assert garble.Restorer([]).restore("line\x85end été") == ("line\x85end été", False)


def test_learns_from_twins(spark):
    lines = ["Die günstige Leine kam nach {} Tagen an", "für größere Küchen gut", "schöne Tasche über Nacht", "Spülgänge und Öffnung", "El botón hace pequeño ruido número {}"]
    rows = [(i, lines[i % 5].format(i), "en") for i in range(60)]
    bad = [(100 + i, misread(lines[i % 5].format(i), "cp1252"), "en") for i in range(5)] + [(200, "gr��ere Taschen", "en"), (201, "f�r größere Küchen gut", "en"), (202, "weiß", "en"), (203, None, "en"), (204, "", "en"), (205, "ascii", "en")]
    bad += [(206, misread("niemals zuvor gesehene Wörter äöüß", "cp1252"), "en")]
    df = spark.createDataFrame(rows + bad, "doc_id bigint, text string, restored string")
    assert set(garble.learn(garble.variants(df))[0]) >= {"utf-8>cp1252"}
    got = {r.doc_id: r.restored for r in garble.garbled(df).collect()}
    assert set(got) == {100, 101, 102, 103, 104, 200, 201, 206}
    assert got[100] == lines[0].format(0) and got[201] == "für größere Küchen gut" and got[206] == "niemals zuvor gesehene Wörter äöüß"
    assert garble.garbled(df.limit(0)).count() == 0


def cleaned(text):
    return markup.clean(text, markup.Labeller().label(text))


def test_only_what_the_cut_labels_is_removed():
    far = " ".join(["plain words about the kettle"] * 60)
    assert cleaned(f"**bold** {far}\n\n> 30 degrees is too hot") == f"bold {far}\n\n> 30 degrees is too hot"
    assert cleaned("> quoted *words* here\n> 30 degrees is too hot") == "quoted words here\n30 degrees is too hot"
    assert cleaned("**bold** rated 5* by us, 4* by them & 2 < 3") == "bold rated 5* by us, 4* by them & 2 < 3"
    assert cleaned("<b>bold</b> AT&T &amp; 3 < 4, <item name> stays") == "bold AT&T & 3 < 4, <item name> stays"


def test_the_cut_differs_from_the_signs_of_the_weights():
    text = "{| class='x'\n| a || b\n|-\n* hand lotion\n* soft [[cushion]]\n|}"
    labeller = markup.Labeller()
    signs = {k: [n for n in ns if n[3] > 0] for k, ns in labeller.nodes(text).items()}
    assert markup.clean(text, labeller.label(text)) != markup.clean(text, signs)


def test_long_spans_and_private_signs():
    for n in (301, 10_000):
        words = "x" * n
        assert cleaned(f"**{words}**") == words and cleaned(f"[[{words}]]") == words and "wiki" in markup.Labeller().label("{{" + words + "|a}}")
    assert cleaned(" **a** \U000f0023 b*c") == " a \U000f0023 b*c"


def test_a_code_page_outside_the_catalogue_is_inferred(spark):
    words = ["schöne", "größe", "müde", "käse", "brüder", "mögen", "bäume", "süße", "fließen", "höhe", "späte", "grüße", "weiß", "kühl", "stärke", "löffel"]
    clean = [f"the {w} kettle {i}" for i in range(3) for w in words]
    read = lambda s: s.encode().decode("iso8859-5")
    docs = clean + [read(s) for s in clean[: len(words)]] + [read("ganz ohne Zwilling: Blödsinn"), "軽い 水筒 one", "丈夫な 水筒 two", "the УЖЕ kettle 1"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    readings, mappings = garble.learn(garble.variants(df))
    assert mappings == {read(c): c for c in "öüäß"}
    got = {r.doc_id: r.restored for r in garble.garbled(df).collect()}
    n = len(clean)
    assert got == {n + i: s for i, s in enumerate(clean[: len(words)])} | {n + len(words): "ganz ohne Zwilling: Blödsinn"}


def test_words_of_any_length_and_readings_of_any_depth(spark):
    deep = "é"
    for _ in range(5):
        deep = deep.encode().decode("cp1252")
    assert garble.Restorer(["utf-8>cp1252"]).restore(f"caf{deep}") == ("café", True)
    long = "á" * 500
    assert [s for _, s, _, _ in garble.occurrences(f"one x{long} two")] == [long] and not list(garble.occurrences("水筒 丈夫 水筒"))
