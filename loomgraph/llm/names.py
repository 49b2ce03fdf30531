"""Variant spellings of names typed by people: suffix blocking and longest-common-subsequence ratio."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.common import components, join_counted, materialize
from loomgraph.llm.strings import fold, lcs_ratio, subsequence

#: Suffixes shorter than this are not indexed.
LEAST_SUFFIX = 4
#: Names of a block that are joined with each other; a larger block is refined with another field, and what is still larger is compared in
#: pieces of about PIECE names, each piece with each. No pair depends on these two, only the cost.
BLOCK, PIECE = 50, 8192
#: Two names are variants from this longest-common-subsequence ratio of the whole names on, and this one of the field that differs.
LEAST_RATIO, LEAST_FIELD = 0.885, 0.8
#: Given names or trades of this many names are words of their own: they are slips of each other only if one is LOPSIDED times as frequent.
OF_ITS_OWN, LOPSIDED = 5, 4
#: A word of this many business names, and of one in COMMON_SHARE of them, says the form or trade of a business: the form if it mostly stands last.
LEAST_COMMON, COMMON_SHARE = 20, 500

#: Words for the form and the trade of a business, for tables too small to learn them from (fixed values).
FORMS = "works international laboratories industries company goods products brothers group associates trading supply manufacturing partners services solutions holdings enterprises studio studios ventures".split()
TRADES = "audio ceramics cycling garden home kitchen lighting nursery office outdoor paper pet sports textile tool travel toys books music food fashion beauty health baby auto jewelry electronics hardware furniture leather glass steel wood".split()
#: Their short forms that aren't the beginning of the word (fixed values).
SHORT = {"intl": "international", "mfg": "manufacturing", "mfrs": "manufacturing", "trdg": "trading", "wks": "works", "gds": "goods", "grp": "group", "bros": "brothers", "co": "company", "prods": "products", "inds": "industries", "labs": "laboratories", "assocs": "associates"}
#: Legal forms (fixed values).
LEGAL = re.compile(r"[\s,(]+(?:co\.?,? *ltd|pty\.? *ltd|ltd|llc|inc|gmbh|s\.? ?a|s\.? ?r\.? ?l|plc|corp|ag|kg|b\.? ?v|n\.? ?v|oy|ab|limited|incorporated)\.?\)?\s*$")
#: Titles, and what follows a name (fixed values).
TITLES = frozenset("dr prof professor mr mrs ms miss sir dame rev hon".split())
TAILS = frozenset("jr sr phd md ii iii iv esq".split())
#: Pet names with the given names they stand for (fixed values).
PET_NAMES = {
    k: v.split()
    for k, v in (
        line.split(": ")
        for line in """abby: abigail|al: albert alan alfred alexander|alex: alexander alexandra|andy: andrew|angie: angela|annie: anne anna|archie: archibald|
barb: barbara|bart: bartholomew|bea: beatrice|becca: rebecca|becky: rebecca|bella: isabella|ben: benjamin|benji: benjamin|benny: benjamin|bernie: bernard|bert: albert herbert robert|
bess: elizabeth|bessie: elizabeth|beth: elizabeth|betsy: elizabeth|betty: elizabeth|bill: william|billy: william|bob: robert|bobby: robert|brad: bradley|cathy: catherine|
charlie: charles charlotte|chris: christopher christine christina|chuck: charles|cindy: cynthia|connie: constance|dan: daniel|danny: daniel|dave: david|deb: deborah|debbie: deborah|dick: richard|
dolly: dorothy|don: donald|dot: dorothy|dottie: dorothy|doug: douglas|drew: andrew|ed: edward edwin edgar|eddie: edward edwin|ellie: eleanor|eliza: elizabeth|elsie: elizabeth|fran: francis frances|frank: francis franklin|
frankie: francis|fred: frederick alfred|gab: gabriella gabriel|gabby: gabriella|gabe: gabriel|gene: eugene|gerry: gerald|gina: regina|ginny: virginia|greg: gregory|gus: augustin augustus gustav|hal: henry harold|hank: henry|
harry: henry harold|hiro: hiroko hiroshi|inga: ingrid|inge: ingrid|izzy: isabella isabel|jack: john|jake: jacob|jamie: james|jan: janet|jeff: jeffrey|jenny: jennifer|jerry: gerald jeremy|jess: jessica|jim: james|jimmy: james|jo: josephine joanna|
joe: joseph|johnny: john|jon: jonathan|josie: josephine|judy: judith|kate: katherine catherine|kathy: katherine kathleen|katie: katherine|kay: katherine|ken: kenneth|kit: katherine christopher|kitty: katherine|larry: lawrence|len: leonard|
lenny: leonard|leo: leonard leopold|les: leslie|libby: elizabeth|lily: lillian|lisa: elizabeth|liz: elizabeth|lizzie: elizabeth|lottie: charlotte|lou: louis louise|ludo: ludwig|lutz: ludwig|lukas: ludwig|maggie: margaret|mandy: amanda|marge: margaret|matt: matthew|
max: maximilian|meg: margaret|mick: michael|mike: michael|millie: mildred|mina: wilhelmina|minnie: wilhelmina|molly: mary|nancy: anne|nat: nathaniel natalie|nate: nathaniel nathan|ned: edward|nell: eleanor|nick: nicholas|nicky: nicholas|nico: nicholas|
obi: obinna|ollie: oliver olivia|pam: pamela|pat: patricia patrick|patsy: patricia|patty: patricia|peg: margaret|peggy: margaret|pete: peter|phil: philip philippa|pip: philippa philip|pippa: philippa|polly: mary|quin: quentin|ray: raymond|rick: richard|
rich: richard|ricky: richard|rob: robert|robbie: robert|ron: ronald|rosie: rose|sally: sarah|sam: samantha samuel|sandy: alexander sandra|sasha: alexander alexandra|stan: stanley|steph: stephanie|steve: stephen steven|stevie: stephen|sue: susan|ted: theodore edward|
teddy: theodore edward|terry: terence theresa|tess: theresa|theo: theodore|tim: timothy|timmy: timothy|tina: christina valentina|toby: tobias|tom: thomas|tommy: thomas|tony: anthony|tori: victoria|tricia: patricia|trish: patricia|trudy: gertrude|ulla: ursula|uschi: ursula|val: valentina valerie|
vic: victor victoria|vicky: victoria|vicki: victoria|vince: vincent|walt: walter|wes: wesley|will: william|willy: william wilhelm|wilma: wilhelmina|winnie: winifred|yvie: yvonne|zac: zachary|zach: zachary|zack: zachary""".replace("\n", "").split("|")
    )
}

_WORDS = re.compile(r"[^\W_]+")
_NUMBERS = re.compile(r"\D+")


class Words:
    """The words for forms and trades of businesses: the fixed ones and those learned from a corpus."""

    def __init__(self, forms: tuple[str, ...] = (), trades: tuple[str, ...] = ()):
        self.forms = frozenset(FORMS) | frozenset(forms) - frozenset(TRADES)
        self.trades = frozenset(TRADES) | frozenset(trades) - self.forms
        self.sorted = [sorted(self.trades), sorted(self.forms)]

    def written_out(self, word: str) -> str:
        """The word that a short form stands for, or the word itself."""
        if word in SHORT:
            return SHORT[word]
        if word in self.forms or word in self.trades or len(word) > 6 or len(word) < 3:
            return word
        for vocabulary in self.sorted:
            hits = [x for x in vocabulary if x.startswith(word)]
            if len(hits) == 1:
                return hits[0]
        hits = [x for x in self.sorted[1] if x[0] == word[0] and x[-1] == word[-1] and 2 * len(word) > len(x) and subsequence(word, x)]
        return hits[0] if len(hits) == 1 else word

    def apart(self, words: list[str]) -> list[str]:
        """Words with a trade that was written onto the word before it set apart."""
        out: list[str] = []
        for w in words:
            cut = next((i for i in range(4, len(w) - 2) if w[i:] in self.trades), 0) if w not in self.forms else 0
            out += [w[:cut], w[cut:]] if cut else [w]
        return out

    def parse(self, words: list[str], df: dict[str, int]) -> tuple[str, str, str, bool]:
        """(core, trade, "", whether only the core is given). The core is the rarest word that is no business word."""
        words = self.apart(words)
        known = [self.written_out(w) for w in words]
        free = [i for i, w in enumerate(known) if w not in self.forms and w not in self.trades]
        if not free:
            return " ".join(known), "", "", False
        at = min(free, key=lambda i: (df.get(words[i], 1), -len(words[i]), i))
        other = sorted(w for i, w in enumerate(known) if i != at and w not in self.forms)
        return words[at], " ".join(other), "", len(words) == 1


def business_words(name: str) -> list[str]:
    """Folded words without legal form and article; words joined with a capital letter stand apart."""
    name = re.sub(r"[®™©]", " ", name)
    legal = LEGAL.search(low := fold(name))
    name = name[: len(name) - (len(low) - legal.start())] if legal and len(low) == len(name) else low[: legal.start()] if legal else name
    name = re.sub(r"(?<=[^\W\d_A-Z])(?=[A-Z])", " ", name.replace("'", "").replace("’", ""))
    out = _WORDS.findall(fold(name))
    return out[1:] if len(out) > 1 and out[0] == "the" else out


def person_words(name: str) -> tuple[list[str], int]:
    """Folded words without role, title and tail; the number of words before a comma, 0 without one."""
    low = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", fold(name).replace("'", "").replace("’", ""))
    front, comma, back = low.partition(",")
    parts = [[w for w in _WORDS.findall(p) if w not in TITLES and w not in TAILS] for p in (front, back)]
    if comma and parts[0] and parts[1]:
        return parts[0] + parts[1], len(parts[0])
    return parts[0] + parts[1], 0


def parse_person(words: list[str], before: int, firsts: dict[str, int]) -> tuple[str, str, str, bool]:
    """(surname, given name or initial, middle initials, whether the given name is only an initial or a pet name)."""
    if before:
        surname, rest = words[:before], words[before:]
    else:
        long = [i for i, w in enumerate(words) if len(w) > 1]
        if not long:
            return " ".join(words), "", "", False
        at = long[-1]
        if len(long) == 2 and long[0] == 0 and firsts.get(words[at], 0) > firsts.get(words[0], 0):
            at = 0  # the surname comes first
        surname, rest = [words[at]], words[:at] + words[at + 1 :]
    given = next((w for w in rest if len(w) > 1), rest[0] if rest else "")
    middle = "".join(w[0] for w in rest[rest.index(given) + 1 :]) if given else ""
    return " ".join(surname), given, middle, bool(given) and (len(given) == 1 or given in PET_NAMES)


def _split(batches: Iterator[pa.RecordBatch], people: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words, before = [], []
        for relation, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            w, n = person_words(value) if relation in people else (business_words(value), 0)
            words.append(w)
            before.append(n)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.string())), pa.array(before, pa.int32())], names=["relation", "value", "words", "before"])


def _parse(batches: Iterator[pa.RecordBatch], people: list[str], vocabulary: Words) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: tuple[list, ...] = ([], [], [], [])
        relations = b.column(0).to_pylist()
        for relation, before, stats in zip(relations, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            stats = sorted(stats, key=lambda s: s["pos"])
            words = [s["word"] for s in stats]
            if relation in people:
                got = parse_person(words, before, {s["word"]: s["firsts"] for s in stats})
            else:
                got = vocabulary.parse(words, {s["word"]: s["df"] for s in stats})
            for column, x in zip(out, got, strict=True):
                column.append(x)
        kinds = (pa.string(), pa.string(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], names=["relation", "value", "core", "other", "middle", "partial"])


def business_vocabulary(stats: DataFrame) -> Words:
    """Forms and trades learned from (person, word, df, lasts). A word needs a share of all words, so they are few whatever the corpus."""
    business = stats.filter("NOT person")
    total = business.agg(F.sum("df")).first()[0] or 0
    common = business.filter((F.col("df") >= LEAST_COMMON) & (F.col("df") * COMMON_SHARE >= total)).select("word", (F.col("lasts") * 2 > F.col("df")).alias("form"), "df").collect()  # at most COMMON_SHARE rows
    forms, trades = [], []
    known = Words()
    for r in sorted(common, key=lambda r: (-r.df, r.word)):
        if known.written_out(r.word) == r.word:  # a short form stands for the word it is short for
            (forms if r.form else trades).append(r.word)
            known = Words(tuple(forms), tuple(trades))
    return known


def parsed(values: DataFrame, people: list[str]) -> DataFrame:
    """relation, value, core, other, middle, partial of each distinct name."""
    names = materialize(
        values.select("relation", "value").filter("relation IS NOT NULL AND value IS NOT NULL").distinct().mapInArrow(
            lambda it: _split(it, people), "relation string, value string, words array<string>, before int"
        ),
        "names",
    )
    words = names.select("relation", "value", "before", (F.size("words") - 1).alias("end"), F.posexplode("words").alias("pos", "word"))
    words = words.withColumn("person", F.col("relation").isin(people))
    first, last = (F.col("pos") == 0) & (F.col("before") == 0), F.col("pos") == F.col("end")
    stats = words.groupBy("person", "word").agg(F.count(F.lit(1)).alias("df"), F.sum(first.cast("int")).alias("firsts"), F.sum(last.cast("int")).alias("lasts"))
    stats = materialize(stats, "words")
    vocabulary = business_vocabulary(stats)
    joined = join_counted(words, stats, ["person", "word"], "df")
    gathered = joined.groupBy("relation", "value", "before").agg(F.collect_list(F.struct("pos", "word", "df", "firsts")).alias("stats"))  # the words of one name
    schema = "relation string, value string, core string, other string, middle string, partial boolean"
    named = gathered.select("relation", "value", "before", "stats").mapInArrow(lambda it: _parse(it, people, vocabulary), schema)
    blank = F.lit("")
    wordless = names.filter(F.size("words") == 0).select("relation", "value", blank.alias("core"), blank.alias("other"), blank.alias("middle"), F.lit(False).alias("partial"))
    return named.unionByName(wordless)


def alike(core_a: str, core_b: str, other_a: str, other_b: str) -> bool:
    """Whether the longest common subsequence of two names that differ in one field says that they are spellings of one."""
    if other_a[-2:-1] == " " == other_b[-2:-1] and other_a != other_b:
        return False  # different middle initials
    if _NUMBERS.sub("", core_a + other_a) != _NUMBERS.sub("", core_b + other_b):
        return False  # numbers aren't misspelt
    if lcs_ratio(f"{core_a} {other_a}", f"{core_b} {other_b}") < LEAST_RATIO:
        return False
    return lcs_ratio(core_a, core_b) >= LEAST_FIELD if other_a == other_b else lcs_ratio(other_a, other_b) >= LEAST_FIELD


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = [alike(*row) for row in zip(*[b.column(i).to_pylist() for i in range(3, 7)], strict=True)]
        yield b.filter(pa.array(keep, pa.bool_()))


def _with_deletions(c: str):
    """Hashes of the text and of all that is left of it after one deletion: texts that are one slip apart have one of these in common."""
    left = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c))), lambda i: F.xxhash64(F.concat(F.left(c, i - 1), F.substr(c, i + 1))))
    return F.array_union(F.array(F.xxhash64(c)), left)


def _close(x: DataFrame, y: DataFrame, on) -> DataFrame:
    """relation, a, b, ca, cb, oa, ob of pairs of keys under a condition that differ in one of the two fields, and by no more edits than the
    ratio allows letters outside the common subsequence."""
    letters = F.length("x.core") + F.length("y.core") + F.length("x.other") + F.length("y.other") + 2
    near = lambda c: F.levenshtein(f"x.{c}", f"y.{c}") <= (1 - LEAST_RATIO) * letters + 1e-9
    close = (F.col("x.other") == F.col("y.other")) & near("core") | (F.col("x.core") == F.col("y.core")) & (F.least(F.length("x.other"), F.length("y.other")) >= 4) & near("other")
    pairs = x.join(y, (F.col("x.relation") == F.col("y.relation")) & on & (F.col("x.key") < F.col("y.key")) & close)
    named = (("x.relation", "relation"), ("x.key", "a"), ("y.key", "b"), ("x.core", "ca"), ("y.core", "cb"), ("x.other", "oa"), ("y.other", "ob"))
    return pairs.select(*[F.col(c).alias(n) for c, n in named]).distinct()


def _bags(texts: list[str]) -> np.ndarray:
    """64 bits a text: which of 32 classes of letters it holds once, and which twice. A letter outside the common subsequence changes one bit at most."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        bits = 0
        for c in text:
            one = 1 << ord(c) % 32
            bits |= one << 32 if bits & one else one
        out[i] = bits
    return out


def near_texts(x: list[str], y: list[str], same: int, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in x and y of all pairs that may be alike; the other field, equal in all, has ``same`` letters. itself: y is x, and each pair is wanted once.

    The bags of all pairs are compared. Those near enough get the length of their longest common subsequence from additions of 64-bit words,
    of 32 classes of letters, so it is never too short. Pairs of a text of more than 64 letters are only compared by bags.
    """
    sizes, bags = [np.array([len(t) for t in z], np.int64) for z in (x, y)], [_bags(x), _bags(y)]
    most = lambda total: np.minimum((1 - LEAST_RATIO) * (total + 2 * same + 2), (1 - LEAST_FIELD) * total) + 1e-9
    widest = most(sizes[0].max(initial=0) + sizes[1].max(initial=0))
    held = np.zeros((len(x), 33), np.uint64)  # the places of each class in a text of x; the last class is what follows a text's end
    for i, text in enumerate(x):
        if len(text) <= 64:
            for at, c in enumerate(text):
                held[i, ord(c) % 32] |= np.uint64(1 << at)
    codes = np.full((len(y), 64), 32, np.uint8)
    for j, text in enumerate(y):
        if len(text) <= 64:
            codes[j, : len(text)] = [ord(c) % 32 for c in text]
    step = max(1, (1 << 20) // max(1, len(y)))
    for at in range(0, len(x), step):
        i, j = np.nonzero(np.bitwise_count(bags[0][at : at + step, None] ^ bags[1][None, :]) <= widest)
        i += at
        total = sizes[0][i] + sizes[1][j]
        keep = (np.bitwise_count(bags[0][i] ^ bags[1][j]) <= most(total)) & (np.abs(sizes[0][i] - sizes[1][j]) <= most(total))
        if itself:
            keep &= i < j
        i, j, total = i[keep], j[keep], total[keep]
        left = np.full(len(i), ~np.uint64(0))
        for k in range(min(64, sizes[1][j].max(initial=0))):
            both = left & held[i, codes[j, k]]
            left = (left + both) | (left - both)
        keep = (total - 2 * np.bitwise_count(~left).astype(np.int64) <= most(total)) | (sizes[0][i] > 64) | (sizes[1][j] > 64)
        yield i[keep], j[keep]


def _compare(group: pa.Table) -> pa.Table:
    """The pairs of two pieces of a block, or of one with itself, that may be alike."""
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    x, y = (group.filter(pc.equal(group["piece"], z)) for z in (low, high))
    found = [(x.take(pa.array(i)), y.take(pa.array(j))) for i, j in near_texts(x["text"].to_pylist(), y["text"].to_pylist(), group["same"][0].as_py(), low == high)]
    out: dict[str, list] = {c: [] for c in ("relation", "a", "b", "ca", "cb", "oa", "ob")}
    for some in found:
        for r, *pair in zip(some[0]["relation"].to_pylist(), *[list(zip(*[t[c].to_pylist() for c in ("key", "core", "other")], strict=True)) for t in some], strict=True):
            (a, ca, oa), (b, cb, ob) = sorted(pair)
            for c, v in zip(out, (r, a, b, ca, cb, oa, ob), strict=True):
                out[c].append(v)
    return pa.table({c: pa.array(v, pa.string()) for c, v in out.items()})


def _all_near(rows: DataFrame, schema) -> DataFrame:
    """relation, a, b, ca, cb, oa, ob of all pairs of a block that may be alike. rows: relation, key, core, other, block, text (the field that
    differs), same (letters of the other). A group holds two pieces at most, whatever the block."""
    rows = rows.withColumn("block", F.concat_ws("\x1d", "block", F.regexp_replace("text", "[^0-9]+", "")))  # numbers are equal
    counted = rows.groupBy("relation", "block").agg(F.ceil(F.count(F.lit(1)) / PIECE).alias("pieces"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pieced = rows.join(counted, ["relation", "block"]).withColumn("piece", F.pmod(F.xxhash64("key"), "pieces"))
    paired = pieced.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    paired = paired.withColumn("low", F.least("piece", "with")).withColumn("high", F.greatest("piece", "with")).drop("with", "pieces")
    return paired.groupBy("relation", "block", "low", "high").applyInArrow(_compare, schema)


def similar_keys(keys: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b of similar keys. keys: key, relation, core, other.

    The index holds the suffixes of both tokens of a name. Every suffix of the core from LEAST_SUFFIX letters on is a block. One that more
    than ``block`` keys share is refined with the other token. The suffix that is the whole other token (a given name, a trade) is too common
    as it stands, so it is refined with the first letters of the core: it finds slips in the core's end. Keys of a block are compared by the
    ratios of their longest common subsequence.

    Nothing is discarded. Refined blocks that are still larger, and the keys of a core that more than ``block`` keys share, are compared in
    pieces, all with all (``near_texts``). So ``block`` changes no result: all pairs are found that are alike and have the core in common, or the
    other token and the core's last LEAST_SUFFIX or first letters. Cores too short for a slip to leave a suffix are joined on what is left of
    them after one deletion too. Other pairs, of several slips that leave neither end, are found through a spelling between them.
    """
    size = F.length("core")
    suffixes = F.transform(F.sequence(F.lit(LEAST_SUFFIX), size), lambda n: F.substr("core", size - n + 1))
    indexed = keys.filter(size >= LEAST_SUFFIX)
    suffix = indexed.select("*", F.explode(suffixes).alias("block"))
    counted = suffix.groupBy("relation", "block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = F.col("n") > block
    blocks = suffix.join(counted, ["relation", "block"]).select(
        *keys.columns, F.when(large, F.concat_ws("\x1f", "block", "other")).otherwise(F.col("block")).alias("block"),
        (large & (F.col("block") == F.col("core"))).alias("split"), (F.length("block") == LEAST_SUFFIX).alias("widest"),
    )
    shortest = F.when(F.col("other") == "", LEAST_SUFFIX).otherwise(LEAST_SUFFIX - 1)
    starts = F.transform(F.sequence(shortest, F.greatest(shortest, size - 1)), lambda n: F.left("core", n))
    second = indexed.select("*", F.explode(starts).alias("start")).select(
        *keys.columns, F.concat_ws("\x1e", "other", "start").alias("block"), F.lit(False).alias("split"), (F.length("start") == shortest).alias("widest")
    )
    blocks = materialize(blocks.unionByName(second), "blocks")
    sizes = blocks.groupBy("relation", "block").agg(F.count(F.lit(1)).alias("n"))
    held = blocks.join(sizes.filter(F.col("n").between(2, block)).drop("n"), ["relation", "block"])
    pairs = _close(held.alias("x"), held.alias("y"), F.col("x.block") == F.col("y.block"))

    # of blocks too large the widest ones hold the pairs of all that refine them
    crowded = blocks.filter("widest").join(sizes.filter(F.col("n") > block).drop("n"), ["relation", "block"], "left_semi")
    of_core = blocks.filter("split").select(*keys.columns).unionByName(keys.filter(size < LEAST_SUFFIX).select(*keys.columns)).filter(F.length("other") >= 4)
    named = ("relation", "key", "core", "other")
    rest = crowded.select(*named, "block", F.col("core").alias("text"), F.length("other").alias("same")).unionByName(
        of_core.select(*named, F.col("core").alias("block"), F.col("other").alias("text"), size.alias("same"))
    )
    short = keys.filter(size <= 2 * LEAST_SUFFIX).withColumn("v", F.explode(_with_deletions("core")))
    slips = _close(short.alias("x"), short.alias("y"), (F.col("x.other") == F.col("y.other")) & (F.col("x.v") == F.col("y.v")))
    pairs = pairs.unionByName(_all_near(rest, pairs.schema)).unionByName(slips)
    found = pairs.distinct().mapInArrow(_near, pairs.schema)

    uses = keys.groupBy("relation", "other").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OF_ITS_OWN)
    use = lambda o: uses.select("relation", F.col("other").alias(o), F.col("n").alias(f"n_{o}"))
    both = found.join(use("oa"), ["relation", "oa"], "left").join(use("ob"), ["relation", "ob"], "left")
    own = (F.col("oa") != F.col("ob")) & (F.least("n_oa", "n_ob") * LOPSIDED > F.greatest("n_oa", "n_ob")) & F.col("n_oa").isNotNull() & F.col("n_ob").isNotNull()
    return both.filter(~F.coalesce(own, F.lit(False))).select("a", "b")


def name_groups(values: DataFrame, people: list[str]) -> DataFrame:
    """relation, value, group_id: one row per distinct name; names of one group mean the same maker or person.

    values: relation STRING, value STRING. people: the relations whose values are persons; the others hold businesses.

    Names are parsed into a core (surname, or the rarest word of a business) and another field (given name, trade). Names equal in both
    are one key. Keys that differ by one slip are found by suffix blocking and joined into components. A name that gives only an
    initial, a pet name or the core of a business joins the component it fits, if it fits exactly one. Different middle
    initials of a name keep persons apart; makers of different trades stay apart.

    Null values and relations take no part; a name without letters or digits is alone in its group. Repeated rows
    count once. Extra columns are ignored. An empty table gives no rows.
    """
    names = materialize(parsed(values, people), "parsed")
    middles = names.filter("middle <> '' AND NOT partial").groupBy("relation", "core", "other").agg(F.count_distinct("middle").alias("n_middle"))
    several = F.coalesce(F.col("n_middle"), F.lit(0)) > 1
    names = (
        names.join(middles, ["relation", "core", "other"], "left")
        .withColumn("partial", F.col("partial") | several & (F.col("middle") == ""))
        .withColumn("other", F.when(several & ~F.col("partial"), F.concat_ws(" ", "other", "middle")).otherwise(F.col("other")))
        .withColumn("key", F.concat_ws("\x1f", "relation", "core", "other", F.col("partial").cast("string"), F.when(F.col("core") == "", F.col("value"))))
    )
    names = materialize(names.select("relation", "value", "core", "other", "partial", "key"), "keyed")
    full = names.filter("NOT partial AND core <> ''").select("key", "relation", "core", "other").distinct()
    parts = components(similar_keys(full), "name-parts")
    full = materialize(full.join(parts, full.key == parts.node, "left").select("key", "relation", "core", "other", F.coalesce("component", "key").alias("component")), "full")

    # what a partial name may stand for: each full name tells its component to all its short forms, with partial sums
    pets: dict[str, list[str]] = {}
    for pet, given in PET_NAMES.items():
        for g in given:
            pets.setdefault(g, []).append(pet)
    pets_of = F.create_map(*[x for g, v in sorted(pets.items()) for x in (F.lit(g), F.array(*[F.lit(p) for p in v]))])
    given = F.substring_index("other", " ", 1)
    forms = F.array_union(F.array(F.lit(""), F.left("other", F.lit(1)), given, F.col("other")), F.coalesce(F.try_element_at(pets_of, given), F.array().cast("array<string>")))
    told = full.select("relation", "core", F.explode(forms).alias("hint"), "component").groupBy("relation", "core", "hint").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    partial = names.filter("partial AND core <> ''").select(F.col("key"), "relation", "core", F.col("other").alias("hint")).distinct()
    attached = partial.join(told.filter("least = most"), ["relation", "core", "hint"]).select("key", F.col("least").alias("component"))
    where = full.select("key", "component").unionByName(attached)
    return names.join(where, "key", "left").select("relation", "value", F.coalesce("component", "key").alias("group_id"))


def variant_pairs(groups: DataFrame) -> DataFrame:
    """relation, value_a, value_b: every pair of a group, the smaller by code point first. The pairs are the result asked for."""
    a = groups.select("relation", "group_id", F.col("value").alias("value_a"))
    b = groups.select("relation", "group_id", F.col("value").alias("value_b"))
    return a.join(b, ["relation", "group_id"]).filter("value_a < value_b").select("relation", "value_a", "value_b")
