import itertools

from loomgraph.llm import listings

CANON = [(1, "hasColor", "Black"), (2, "hasColor", "Rose Gold"), (3, "hasColor", "Navy")]
TERMS = [("hasColor", "noir", 1), ("hasColor", "midnight", 3)]
KINDS = ["Dry Bag", "Waterproof Sack", "Herbal Tea", "Wall Frame"]


def groups(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "product_id string, title string, text string, group_id string")
    tax = spark.createDataFrame([(k,) for k in KINDS] + [(None,)], "kind string")
    canon = spark.createDataFrame(CANON, "canonical_id bigint, relation string, canonical string")
    terms = spark.createDataFrame(TERMS, "relation string, term string, canonical_id bigint")
    return listings.item_groups(df, tax, canon, terms)


def pairs(spark, rows):
    return {tuple(r) for r in listings.item_pairs(groups(spark, rows)).collect()}


def test_sizes():
    read = lambda s, f=None: listings.size_of(listings._SIZE.search(s), f)
    assert read("183 x 61 cm") == read('72" by 24"') == read("61x183cm") == "mm:610x1830"
    assert read("1 L") == read("33.8 fl oz") == read("1000ml") == read("33.8 oz", "ml") == "ml:1000"
    assert read("12 oz") == read("340 grams") == "g:340" and read("35.4 inch") == read("0.9 m") == "mm:900"


def test_same_item_in_other_words(spark):
    syn = [(f"S{i}", f"Maker{i} Goods Tarn Dry Bag 1 L Black", "A waterproof sack people keep.") for i in range(3)]
    syn += [(f"T{i}", f"Maker{i} Goods Tarn Dry Bag 2 L Black Premium", "") for i in range(3)]  # shows that Premium is a seller's word
    same = [
        ("A", "Zorusavum Tool Goods Ember Dry Bag 1000ml Black pack of 2", ""), ("B", "Ember by Zorusavum Tool Gds waterproof sack 33.8 fl oz NOIR 2 pcs Premium", None),
        ("C", "Deluxe Waterproof Sack - Zorusavum Tool Goods Ember", "You get 1 L. Color: black. Sold as 2 pcs."), ("D", "Ember by ZORUSAVUM TOOL GOODS Dry Bag ##2", "Size: 1 L | Colour as listed: Noir | Qty: set of 2"),
    ]
    other = [
        ("E", "Zorusavum Tool Goods Ember Dry Bag 1000ml Black", ""), ("F", "Zorusavum Garden Works Ember Dry Bag 1000ml Black pack of 2", ""), ("G", "Zorusavum Tool Goods Tarn Dry Bag 1000ml Black pack of 2", ""),
        ("H", "Zorusavum Tool Goods Ember Dry Bag 500ml Black pack of 2", ""), ("I", "Zorusavum Tool Goods Ember Dry Bag 1000ml Rose Gold pack of 2", ""), ("J", "Zorusavum Tool Goods Ember Herbal Tea 1000ml Black pack of 2", ""),
        ("K", "The Black Garden (Zorusavum Tool Goods)", "Hardcover"), ("L", None, "text"),
    ]
    got = pairs(spark, syn + same + other)
    assert got == set(itertools.combinations("ABCD", 2))


def test_a_token_that_is_missing_is_a_value_of_its_own(spark):
    rows = [("A", "Brimo Works Tarn Wall Frame 30 x 20 cm Black", ""), ("B", "Brimo Works Tarn Wall Frame 30 x 20 cm", ""), ("C", "Tarn by Brimo Works Wall Frame 20 x 30 cm", "")]
    assert pairs(spark, rows) == {("B", "C")}


def test_combinations_are_k_of_the_words_and_few(spark):
    of = lambda words: {" ".join(words[a:b] + words[c:d]) for a, b, c, d in listings.combinations(words)}
    assert of(list("abcd")) == {"a b", "b c", "c d", "a b c", "b c d", "a c", "b d", "a d", "a b d", "a c d", "a b c d"}
    assert of(["a"]) == {"a"} and of([]) == {""}
    count = lambda n: sum(1 for _ in listings.combinations(["w"] * n))
    assert count(2000) - count(1000) == 1000 * (count(101) - count(100))


def test_votes_match_brute_force(spark):
    titles = [["a", "b", "r"], ["a", "b", "r", "new"], ["hot", "a", "b", "r"], ["c", "d", "s"], ["c", "d", "s", "new"], ["s", "c", "d"], ["x", "y"], ["a", "b", "hot", "sale", "r"], ["z"]]
    df = spark.createDataFrame([(i, w, i + 1) for i, w in enumerate(titles)], "title bigint, words array<string>, n bigint")
    from math import log2

    frequency, places, whole = {}, {}, {tuple(sorted(w)) for w in titles}
    for i, w in enumerate(titles):
        for a, b, c, d in listings.combinations(w):
            at = [*range(a, b), *range(c, d)]
            key = tuple(sorted(w[j] for j in at))
            frequency[key] = frequency.get(key, 0) + i + 1
            places.setdefault(key, []).extend([sum(at) / len(at)] * (i + 1))
    points = lambda key: len(key) ** 2 * log2(frequency[key]) / (1 + sum(places[key]) / len(places[key]))
    got = {r.title: r for r in listings.elected(df).collect()}
    for i, w in enumerate(titles):
        options = {tuple(sorted(w[j] for j in [*range(a, b), *range(c, d)])) for a, b, c, d in listings.combinations(w)} & whole
        r = got[i]
        assert tuple(sorted(w[r.start : r.off] + w[r.on : r.end])) == max(options, key=points)


def test_the_score_decides(spark, monkeypatch):
    makers = ["Zorusavum Tool", "Brimolek Garden", "Grelotin Pet", "Vulpasor Home", "Kestrodin Audio", "Fendrimak Office"]
    rows = [(f"{i}{j}", t.format(f"{m} Goods"), "") for i, m in enumerate(makers) for j, t in enumerate(["{} Ember Dry Bag 1 L Black", "Free Delivery Dry Bag - {} Ember 1000ml Black", "Ember by {} Dry Bag Noir 1 L"])]
    wanted = {(f"{i}{a}", f"{i}{b}") for i in range(6) for a, b in ((0, 1), (0, 2), (1, 2))}
    assert pairs(spark, rows) == wanted
    monkeypatch.setattr(listings, "score", lambda frequency, length, position: 0 * frequency)
    assert pairs(spark, rows) != wanted


def test_edge_cases(spark):
    assert pairs(spark, []) == set()
    long = " ".join(f"w{i}" for i in range(3000))
    assert pairs(spark, [("A", f"{long} Wall Frame Black", ""), ("B", f"Wall Frame Black {long}", "")]) == {("A", "B")}
    rows = [("A", "Brimo Works Tarn Wall Frame Black", "x " * 50_000), ("A", "Brimo Works Tarn Wall Frame Black", ""), ("B", "wall frame", ""), ("C", "", "")]
    assert pairs(spark, rows) == set()


def test_description_is_all_after_the_title(spark):
    from pyspark.sql import functions as F

    from loomgraph.llm.queries import description

    df = spark.createDataFrame([("Mug . Color: black . You get 1 L.",), ("Mug . one",), ("only text",), (None,)], "text string")
    assert [r.d for r in df.select("text", description(F.col("text")).alias("d")).collect()] == ["Color: black . You get 1 L.", "one", "only text", None]
