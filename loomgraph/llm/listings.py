"""Product listings that describe the same item: title combination voting over normalised title tokens."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.common import WHITE, discard, materialize
from loomgraph.llm.canonical import mappers
from loomgraph.llm.names import name_groups
from loomgraph.llm.strings import fold, tokens

#: Words of a combination, at least and at most, and the words it may leave out between two of its own. Words before and after it are free.
LEAST_WORDS, MOST_WORDS, GAP = 2, 8, 4
#: A word that the winning combinations leave out in half of the titles it is in, and that is in this many titles and in one of
#: SELLER_SHARE of all, is a seller's word.
LEAST_TITLES, SELLER_SHARE = 3, 5000
#: Two words for one kind of goods are met in this many listings, one in the title and one in the text.
LEAST_TOGETHER = 3

_NUMBER = r"\d+(?:[.,]\d+)?"
_LENGTH = r"cm|mm|m|inches|inch|in\.?|\"|″|''|ft"
_SIZE = re.compile(
    rf"(?<![\w.])({_NUMBER}) ?({_LENGTH})? ?(?:x|×|by|\*) ?({_NUMBER}) ?({_LENGTH})(?![\w])"
    rf"|(?<![\w.])({_NUMBER}) ?(fl\.? ?oz|ounces|ounce|oz|millilitres?|ml|cl|litres?|liters?|l|kilograms?|kg|grams?|g|pounds?|lbs?|{_LENGTH})(?![\w])",
    re.I,
)
_PACK = re.compile(r"\(?\b(?:set|pack|box|bundle) of (\d+)\b\)?|\(?(?<![\w.])(\d+)[ -]?(?:pcs|pieces|piece|pc|count|ct|pack|packs)\b\)?", re.I)
#: Base units: millimetres, millilitres, grams (fixed values).
_UNITS = {
    "cm": ("mm", 10.0), "mm": ("mm", 1.0), "m": ("mm", 1000.0), "inch": ("mm", 25.4), "inches": ("mm", 25.4), "in": ("mm", 25.4), '"': ("mm", 25.4), "″": ("mm", 25.4), "''": ("mm", 25.4), "ft": ("mm", 304.8),
    "ml": ("ml", 1.0), "millilitre": ("ml", 1.0), "millilitres": ("ml", 1.0), "cl": ("ml", 10.0), "l": ("ml", 1000.0), "litre": ("ml", 1000.0), "litres": ("ml", 1000.0), "liter": ("ml", 1000.0), "liters": ("ml", 1000.0), "floz": ("ml", 29.5735295625),
    "g": ("g", 1.0), "gram": ("g", 1.0), "grams": ("g", 1.0), "kg": ("g", 1000.0), "kilogram": ("g", 1000.0), "kilograms": ("g", 1000.0), "lb": ("g", 453.59237), "lbs": ("g", 453.59237), "pound": ("g", 453.59237), "pounds": ("g", 453.59237),
    "oz": ("g", 28.349523125), "ounce": ("g", 28.349523125), "ounces": ("g", 28.349523125),
}
_IMPERIAL = frozenset(("inch", "inches", "in", '"', "″", "''", "ft", "floz", "lb", "lbs", "pound", "pounds", "oz", "ounce", "ounces"))
_LABEL = re.compile(r"(?:colou?r as listed|colou?r|finished in|comes in)[: ]+([^.|;]+)", re.I)


def snapped(number: str, unit: str, family: str | None = None) -> tuple[str, int]:
    """(base unit, amount): a rounded foreign measure becomes the round metric amount it may have been written from."""
    unit = unit.lower().replace(" ", "").replace(".", "")
    base, factor = _UNITS[unit]
    if family == "ml" and unit in ("oz", "ounce", "ounces"):
        base, factor = _UNITS["floz"]
    number = number.replace(",", ".")
    amount = float(number) * factor
    if unit in _IMPERIAL:
        digits = len(number.partition(".")[2])
        slack = 0.51 * 10.0 ** -max(digits, 1) * factor
        for step in (50, 10, 5) if base == "mm" else (50, 10, 5):
            near = round(amount / step) * step
            if near and abs(near - amount) <= slack:
                return base, near
    return base, round(amount)


def size_of(m: re.Match, family: str | None = None) -> str:
    if m[1]:
        unit = m[4]
        sides = sorted((snapped(m[1], m[2] or unit)[1], snapped(m[3], unit)[1]))
        return f"mm:{sides[0]}x{sides[1]}"
    base, amount = snapped(m[5], m[6], family)
    return f"{base}:{amount}"


class TitleReader:
    """Splits a listing's title and text into maker, range, kind, colour, size and count."""

    def __init__(self, kinds: list[str], canon: list[tuple], terms: list[tuple]):
        words = sorted({fold(k) for k in kinds}, key=lambda k: -len(k))
        self.kind = re.compile(r"(?<![\w-])(?:" + "|".join(re.escape(k) for k in words) + r")(?![\w-])") if words else re.compile(r"(?!)")
        self.colours = mappers(canon, terms).get("hasColor")
        known = sorted({fold(n) for _, r, n in canon if r == "hasColor" and n} | {fold(t) for r, t, _ in terms if r == "hasColor" and t}, key=lambda k: -len(k))
        self.colour = re.compile(r"(?<![\w-])(?:" + "|".join(re.escape(k) for k in known) + r")(?: colou?r)?(?![\w-])") if known else re.compile(r"(?!)")

    def colour_id(self, s: str) -> int:
        return self.colours.find(s) if self.colours and s.strip() else 0

    def read(self, title: str, text: str) -> dict:
        title = re.sub(r"\s*##\s*\d+\s*$", "", title)
        plain = title.translate(_BLANKS)
        low = plain.lower() if plain.isascii() else _same_length(plain)
        out: dict = {}
        kind = self.kind.search(low)
        told = self.kind.search(fold(text))
        out["kind"] = " ".join(tokens(kind[0])) if kind else ""
        out["kind_text"] = " ".join(tokens(told[0])) if told else ""
        if not kind:
            return out
        gone = [kind.span()]
        rest = _blanked(low, kind)

        def take(pattern: re.Pattern) -> re.Match | None:
            nonlocal rest
            m = pattern.search(rest)
            if m:
                gone.append(m.span())
                rest = _blanked(rest, m)
            return m

        pack = take(_PACK)
        size = take(_SIZE)
        colour = take(self.colour)
        packed = pack or _PACK.search(text)
        out["pack"] = int(next(g for g in packed.groups() if g)) if packed else 1
        sized = size or _SIZE.search(_PACK.sub(" ", text))
        out["size"], out["size_fluid"], out["metric"] = "", "", ""
        if sized:
            out["size"], out["size_fluid"] = size_of(sized), size_of(sized, "ml")
            unit = (sized[6] or "").lower().replace(" ", "").replace(".", "")
            if unit and unit not in ("oz", "ounce", "ounces"):
                out["metric"] = out["size"].partition(":")[0]
        out["colour"] = self.colour_id(colour[0]) if colour else next((i for m in _LABEL.finditer(text) if (i := self.colour_id(m[1]))), 0)
        for start, end in gone:
            plain = plain[:start] + "|" * (end - start) + plain[end:]
        out["words"] = self.words(plain)
        return out

    @staticmethod
    def words(plain: str) -> list[str]:
        """What is left of the title, as written: the maker's words before those of the range, which stand before ``by`` or behind the maker."""
        out: list[str] = []
        for part in re.split(r"\|+|\s-\s", plain):
            words = [w for w in part.split() if tokens(w)]
            by = next((i for i, w in enumerate(words) if fold(w) == "by"), None)
            out += words if by is None else words[by + 1 :] + words[:by]
        return [w for w in out if fold(w).strip(",.") not in ("color", "colour")]


def _blanked(s: str, m: re.Match) -> str:
    return s[: m.start()] + "|" * (m.end() - m.start()) + s[m.end() :]


_BLANKS = {ord(c): " " for c in WHITE}


def _same_length(s: str) -> str:
    """Letters without accents, one for one, so that positions hold."""
    return "".join(f if len(f := fold(c)) == 1 else c for c in s)


def read_listings(listings: DataFrame, kinds: list[str], canon: DataFrame, terms: DataFrame) -> DataFrame:
    """product_id, words, title, kind, kind_text, colour, size, size_fluid, metric, pack of listings whose title names a kind of goods. words are
    what the title holds besides these tokens; title is their folded form."""
    lists = [tuple(r) for r in canon.select("canonical_id", "relation", "canonical").collect()]  # reference lists of fixed size
    known = [tuple(r) for r in terms.select("relation", "term", "canonical_id").collect()]
    types = {
        "words": pa.list_(pa.string()), "kind": pa.string(), "kind_text": pa.string(), "colour": pa.int64(), "size": pa.string(), "size_fluid": pa.string(), "metric": pa.string(), "pack": pa.int64(),
    }
    schema = "product_id string, words array<string>, kind string, kind_text string, colour bigint, size string, size_fluid string, metric string, pack bigint, title array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TitleReader(kinds, lists, known)
        for b in batches:
            ids, rows = [], []
            for i, title, text in zip(*[b.column(j).to_pylist() for j in range(3)], strict=True):
                r = reader.read(title, text or "")
                if r["kind"]:
                    ids.append(i)
                    rows.append(r)
            folded = [["".join(tokens(w)) for w in r["words"]] for r in rows]
            columns = [pa.array([r[c] for r in rows], t) for c, t in types.items()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), *columns, pa.array(folded, pa.list_(pa.string()))], names=["product_id", *types, "title"])

    return listings.select("product_id", "title", "text").filter("title IS NOT NULL").mapInArrow(run, schema)


def combinations(words: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """(start, left out from, to, end) of the combinations of a title: up to MOST_WORDS of its words, in order, with at most one stretch of up
    to GAP words left out between them, and the whole title. Their number grows with the title's length, not with a power of it."""
    n = len(words)
    for start in range(n):
        for end in range(start + LEAST_WORDS, min(n, start + MOST_WORDS + GAP) + 1):
            if end - start <= MOST_WORDS and end - start < n:
                yield start, end, end, end
            for gap in range(1, min(GAP, end - start - LEAST_WORDS) + 1):
                if end - start - gap <= MOST_WORDS:
                    for at in range(start + 1, end - gap):
                        yield start, at, at + gap, end
    yield 0, n, n, n


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (title, n, combination, whole, length, position, start, off, on, end). A combination is known by the sum of its words' 64-bit hashes,
    whatever their order; sums over stretches of a title are differences of running sums."""
    names = ["title", "n", "combination", "whole", "length", "position", "start", "off", "on", "end"]
    known: dict[int, np.ndarray] = {}  # the places of the combinations of a title by its length

    def parts(length: int) -> Iterator[np.ndarray]:
        if length in known:
            yield known[length]
            return
        for some in itertools.batched(combinations([""] * length), 200_000):
            places = np.array(some, np.int32).T
            if length < 100:
                known[length] = places
            yield places

    for b in batches:
        by_length: dict[int, list[int]] = {}
        titles = b.column(1).to_pylist()
        for i, words in enumerate(titles):
            by_length.setdefault(len(words), []).append(i)
        marks: dict[str, int] = {}
        for words in titles:
            for w in words:
                if w not in marks:
                    marks[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
        for length, rows in by_length.items():
            for places in parts(length):
                step = max(1, 200_000 // places.shape[1])  # titles of one batch
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    sums = np.zeros((len(some), length + 1), np.uint64)
                    np.cumsum(np.array([[marks[w] for w in titles[i]] for i in some], np.uint64).reshape(len(some), length), axis=1, out=sums[:, 1:])
                    start, off, on, end = places
                    combined = sums[:, off] - sums[:, start] + sums[:, end] - sums[:, on]
                    size = off - start + end - on
                    total = (off.astype(np.int64) * (off - 1) - start.astype(np.int64) * (start - 1) + end.astype(np.int64) * (end - 1) - on.astype(np.int64) * (on - 1)) / 2
                    many = lambda x: np.tile(x, len(some))  # noqa: B023, E731
                    each = lambda j: np.repeat(b.column(j).take(pa.array(some)).to_numpy(), places.shape[1])  # noqa: B023, E731
                    columns = [each(0), each(2), combined.astype(np.int64).ravel(), many(size == length), many(size), many(total / np.maximum(size, 1)), *map(many, places)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def score(frequency: Column, length: Column, position: Column) -> Column:
    """How well a combination names the item of a title that holds it: many titles, many words, near the title's start."""
    return F.pow(length, F.lit(2)) * F.log2(frequency) / (1 + position)


def elected(titles: DataFrame) -> DataFrame:
    """title, start, off, on, end: the combination of words that names the item of each title. titles: title (a key), words, n (listings).

    Every title votes for all its combinations, with as many votes as it has listings; the position of a combination is measured in each title
    that holds it and averaged. Those that no title consists of are no names; of the others a title takes the one that scores best.
    """
    schema = "title bigint, n bigint, combination bigint, whole boolean, length int, position double, start int, off int, on int, end int"
    votes = materialize(titles.select("title", "words", "n").mapInArrow(_combine, schema), "votes")
    tally = votes.groupBy("combination").agg(
        F.sum("n").alias("frequency"), F.max("whole").alias("named"), (F.sum(F.col("position") * F.col("n")) / F.sum("n")).alias("average"),
    ).filter("named").drop("named")
    order = F.struct(score(F.col("frequency"), F.col("length"), F.col("average")).alias("score"), "length", "combination")
    place = F.struct("start", "off", "on", "end")
    best = materialize(votes.join(tally, "combination").groupBy("title").agg(F.max_by(place, order).alias("best")).select("title", "best.*"), "elected")
    discard(votes)
    return best


def _kept(column: str) -> Column:
    part = lambda a, b: F.slice(column, F.col(a) + 1, F.col(b) - F.col(a))
    return F.concat(part("start", "off"), part("on", "end"))


def named(read: DataFrame) -> DataFrame:
    """read with maker and range: the words of the combination that wins the vote, without those that sellers add to any title.

    Two rounds. The first shows which words lose: seller's words ("free shipping") are left out wherever a title without them exists. Their
    number is bounded by the share of titles each must have. The second round votes on what is left.
    """
    titles = lambda c: read.groupBy(F.xxhash64(c).alias("title")).agg(F.first(c).alias("words"), F.count(F.lit(1)).alias("n"))
    first = materialize(titles(F.col("title")), "titles")
    total = first.count()
    won = first.join(elected(first), "title").select("words", _kept("words").alias("kept"))
    lost = won.select(F.explode(F.array_distinct("words")).alias("word"), "kept").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.array_contains("kept", F.col("word"))).alias("out"))
    sellers = [r.word for r in lost.filter((F.col("n") >= LEAST_TITLES) & (F.col("n") * SELLER_SHARE >= total) & (F.col("out") * 2 >= F.col("n"))).select("word").collect()]
    plain = F.array_except("title", F.array(*[F.lit(w) for w in sorted(sellers)])) if sellers else F.col("title")
    own = F.filter(F.arrays_zip(F.col("words").alias("w"), F.col("title").alias("t")), lambda x: F.array_contains(plain, x["t"]))
    read = read.withColumn("own", own).withColumn("words", F.col("own.w")).withColumn("title", F.col("own.t")).drop("own")
    second = materialize(read.groupBy(F.xxhash64("title").alias("title")).agg(F.first("title").alias("words"), F.count(F.lit(1)).alias("n")), "titles")
    chosen = elected(second)
    parts = read.withColumn("k", F.xxhash64("title")).join(chosen.withColumnRenamed("title", "k"), "k").withColumn("kept", _kept("words")).withColumn("folded", _kept("title"))
    several = F.size("kept") > 1
    return parts.withColumn("maker", F.when(several, F.array_join(F.slice("kept", F.lit(1), F.size("kept") - 1), " ")).otherwise(F.coalesce(F.get("kept", F.lit(0)), F.lit("")))).withColumn(
        "range", F.when(several, F.element_at("folded", -1)).otherwise("")
    )


def synonyms(read: DataFrame) -> dict[str, str]:
    """Kind of goods -> first word of its group: words of which listings use one in the title and the other in the text. The taxonomy bounds the pairs."""
    pairs = read.filter("kind_text <> '' AND kind_text <> kind").groupBy("kind", "kind_text").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_TOGETHER)
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in sorted(pairs.collect()):
        a, b = sorted((find(r.kind), find(r.kind_text)))
        root[b] = a
    return {k: find(k) for k in list(root)}


def item_groups(listings: DataFrame, taxonomy: DataFrame, canon: DataFrame, terms: DataFrame) -> DataFrame:
    """product_id, group_id: listings with the same group_id offer the same item (maker, range, kind, colour, size, count).

    listings: product_id, title, text (one row per product; the text tells what the title leaves out). taxonomy: kind, a list of
    kinds of goods. canon and terms: the colours and their known names, as in map_values.

    1. Tokens with a form of their own are read from each title: kind, colour, size in metric units, count (one where none is given). The words
       left name maker and range, among words of the seller.
    2. Title combination voting (``elected``): every title votes for the k-combinations of its words; one scores by frequency, length and
       average position, and each title takes its best, in two rounds that first show which words are only the sellers'.
    3. The clusters of the winning combinations are verified: listings of different kinds, colours, sizes or counts are kept apart. A colour
       or size that a listing gives nowhere is one that its item hasn't, so such listings are an item of their own.
    4. Clusters are merged where their makers are spellings of one, as in name_groups, and their kinds are words for one, as sellers
       use both for one listing.

    A null title, and one without a kind of the taxonomy (books, films), has no row. Nulls and blanks in text count as no text.
    Of several rows of a product the columns must have been chosen before; repeated rows give repeated rows. Empty tables give no rows.
    """
    kinds = sorted(r.kind for r in taxonomy.select("kind").filter("kind IS NOT NULL").distinct().collect())  # the taxonomy of kinds, which doesn't grow with the data
    read = materialize(read_listings(listings, kinds, canon, terms), "listings")
    voted = materialize(named(read).select("product_id", "maker", "range", "kind", "colour", "size", "size_fluid", "pack"), "voted")
    same = synonyms(read)
    fluid = [r.kind for r in read.filter("metric IN ('ml', 'g')").groupBy("kind").agg(F.avg((F.col("metric") == "ml").cast("int")).alias("share")).filter("share > 0.5").collect()]
    fluid = sorted({k for k in kinds_of(same, kinds) if same.get(k, k) in {same.get(f, f) for f in fluid}})
    group = F.create_map(*[x for k, v in same.items() for x in (F.lit(k), F.lit(v))]) if same else None
    kind = F.coalesce(F.try_element_at(group, F.col("kind")), F.col("kind")) if same else F.col("kind")
    makers = name_groups(voted.select(F.lit("maker").alias("relation"), F.col("maker").alias("value")).filter("maker <> ''"), [])
    items = voted.join(makers.select(F.col("value").alias("maker"), F.col("group_id").alias("m")), "maker", "left").select(
        "product_id", F.coalesce("m", "maker").alias("m"), "range", kind.alias("kind"), "colour",
        F.when(F.col("kind").isin(fluid), F.col("size_fluid")).otherwise(F.col("size")).alias("size"), "pack",
    )
    item = F.xxhash64("m", "range", "kind", "pack", F.when(F.col("colour") > 0, F.col("colour")), F.when(F.col("size") != "", F.col("size")))
    return items.select("product_id", item.alias("group_id"))


def kinds_of(same: dict[str, str], kinds: list[str]) -> list[str]:
    return sorted({" ".join(tokens(k)) for k in kinds} | set(same))


def item_pairs(groups: DataFrame) -> DataFrame:
    """product_a, product_b: every pair of different products of a group, the smaller first. The pairs are the result asked for."""
    g = groups.select("product_id", "group_id").distinct()
    a, b = g.select("group_id", F.col("product_id").alias("product_a")), g.select("group_id", F.col("product_id").alias("product_b"))
    return a.join(b, "group_id").filter("product_a < product_b").select("product_a", "product_b").distinct()
