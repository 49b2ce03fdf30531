"""Garbled text from wrong character encoding: mappings learned from clean near-twins, applied to the rest."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.common import materialize

#: Encodings in which text may have been read by mistake, and in which it may have been written (fixed values).
READ_AS = ("cp1252", "latin-1", "iso8859-15", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "cp437", "cp850", "cp852", "mac_roman", "cp1254", "cp1257")
WRITTEN_IN = ("utf-8", "cp1251", "koi8-r", "cp1250", "iso8859-2")
#: A transformation is learned from this many different pairs of a garbled and a clean string.
LEAST_PAIRS = 2
#: A mapping of characters that no reading of the catalogue explains is learned from this many words with a twin, if it is what their strings
#: turn into in this share of the words they are in.
LEAST_WORDS, SURE = 4, 0.9
#: Mappings, at least, that must agree on one unknown code page, and the characters of such pages (letters, signs, box drawing; no kana or emoji).
LEAST_MAPPINGS, LAST_OF_PAGES = 3, 0x25FF

_ASCII_WORD = re.compile(r"[^ \t\r\n]+")
_FOREIGN = re.compile(r"[^\x00-\x7f]+")
_DIGITS = re.compile(r"\d+")
_CONTROL = re.compile("[\x80-\x84\x86-\x9f]")  # U+0085 is a line end
_LOST = "�"
#: What every text has that a Restorer may change or report: readings make two characters or more of one.
_GATE = re.compile("[^\x00-\x7f]{2}|[\x80-\x9f\ufffd]")


def alphabet(codec: str) -> list[str]:
    """The character of each byte; bytes without one stand for the control character of the same number, as lenient readers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _class(chars: list[str]) -> str:
    """A character class of those beyond ASCII."""
    return "[" + "".join(re.escape(c) for c in chars if ord(c) > 127) + "]"


class Reader:
    """Text written in one encoding and read in another."""

    def __init__(self, read_as: str, written_in: str):
        self.name = f"{written_in}>{read_as}"
        self.written_in = written_in
        chars = alphabet(read_as)
        self.to_byte = {c: b for b, c in reversed(list(enumerate(chars)))}
        self.chars = chars
        if written_in == "utf-8":
            of = lambda lo, hi: _class(chars[lo : hi + 1])
            cont = of(0x80, 0xBF)
            self.pattern = re.compile(f"{of(0xC2, 0xDF)}{cont}|{of(0xE0, 0xEF)}{cont}{cont}|{of(0xF0, 0xF4)}{cont}{cont}{cont}")
            self.gate = re.compile(of(0xC2, 0xF4) + cont)
        else:
            self.pattern = None

    def garble(self, clean: str) -> str | None:
        try:
            return "".join(self.chars[b] for b in clean.encode(self.written_in))
        except UnicodeEncodeError:
            return None

    def bytes_of(self, s: str) -> bytes | None:
        try:
            return bytes([self.to_byte[c] for c in s])
        except KeyError:
            return None

    def restore(self, text: str) -> str:
        """``text`` with every passage that this reading explains put right."""
        if self.pattern is not None:
            if not self.gate.search(text):
                return text
            return self.pattern.sub(self._character, text)
        sure = False

        def word(m: re.Match, least: int) -> str:
            nonlocal sure
            b = self.bytes_of(m[0])
            if b is None or len(m[0]) < least:
                return m[0]
            try:
                r = b.decode(self.written_in)
            except UnicodeDecodeError:
                return m[0]
            if not all("А" <= c <= "я" or c in "Ёё" for c in r) or any("Ѐ" <= c <= "ӿ" for c in m[0]):
                return m[0]
            if r[1:] != r[1:].lower() and r != r.upper():
                return m[0]  # capitals inside a word: not this encoding
            sure = True
            return r

        out = _LETTERS.sub(lambda m: word(m, 3), text)
        return _LETTERS.sub(lambda m: word(m, 1), out) if sure else out

    def whole(self, s: str) -> str | None:
        """The restored string if this reading explains all of it."""
        b = self.bytes_of(s) if self.pattern is not None else None
        try:
            r = b.decode("utf-8") if b else None
        except UnicodeDecodeError:
            return None
        return r if r and len(r) < len(s) and plausible(r) else None

    def _character(self, m: re.Match) -> str:
        b = self.bytes_of(m[0])
        try:
            r = b.decode("utf-8")
        except (UnicodeDecodeError, AttributeError):
            return m[0]
        if "\x80" <= r <= "\x9f" and _CONTROL.search(m[0]):
            return r  # half of a character that was read wrongly twice
        return r if plausible(r) else m[0]


#: Words without any ASCII letter or digit beside them.
_LETTERS = re.compile(r"(?<![A-Za-z0-9\x80-￿])[\xa8\xb8\xb3\xbf\xaa\xba\xa5\xb4\xc0-￿]+(?![A-Za-z0-9\x80-￿])")


def plausible(s: str) -> bool:
    """Whether each character belongs to a script or to signs that running text of the corpus's kind uses: Latin with its
    extensions, Cyrillic, kana, CJK, Hangul, punctuation, currency, letter-like and mathematical signs, emoji, no controls."""
    for c in s:
        o = ord(c)
        if not (
            0xA0 <= o <= 0x17F or o == 0x192 or 0x218 <= o <= 0x21B or 0x2C6 <= o <= 0x2DD or 0x400 <= o <= 0x45F or 0x490 <= o <= 0x491
            or 0x1E00 <= o <= 0x1EFF or 0x2000 <= o <= 0x200A or 0x2010 <= o <= 0x205F or 0x20A0 <= o <= 0x20BF or 0x2100 <= o <= 0x23FF or 0x2500 <= o <= 0x27BF
            or 0x3000 <= o <= 0x30FF or 0x4E00 <= o <= 0x9FFF or 0xAC00 <= o <= 0xD7A3 or 0xFE0F == o or 0xFF00 <= o <= 0xFFEF or 0x1F000 <= o <= 0x1FAFF or o == 0x200D
        ):
            return False
    return True


def readers(names: list[str] | None = None) -> list[Reader]:
    """All readings, or those named, in the order of the catalogue."""
    every = [(r, w) for w in WRITTEN_IN for r in READ_AS if r != w]
    return [Reader(r, w) for r, w in every if names is None or f"{w}>{r}" in names]


def skeleton(word: str) -> str:
    """The ASCII part of a word, digits made alike."""
    if not word.isascii():
        word = _FOREIGN.sub("", word)
    return word if word.isalpha() else _DIGITS.sub("0", word)


def occurrences(text: str) -> Iterator[tuple[int, str, int, int]]:
    """(key, its non-ASCII strings joined by U+001F, start, end) of each word with a non-ASCII character.

    The key is a hash of what near-twins have in common: the word's skeleton and those of the words beside it; for a word of which
    three letters or more are left, the word's skeleton alone comes second.
    """
    words = _ASCII_WORD.findall(text)
    bare: dict[int, str] = {}

    def at(i: int) -> str:
        if not 0 <= i < len(words):
            return "\n"
        if i not in bare:
            bare[i] = skeleton(words[i])
        return bare[i]

    end = 0
    for i, w in enumerate(words):
        if w.isascii():
            continue
        start = text.index(w, end)
        end = start + len(w)
        if not any(c.isalnum() for j in (i - 1, i, i + 1) for c in at(j)):
            continue  # nothing is left that a twin could be known by
        strings = "\x1f".join(_FOREIGN.findall(w))
        yield _hash(f"{at(i - 1)}\x1e{at(i)}\x1e{at(i + 1)}"), strings, start, end
        if sum(map(str.isalpha, at(i))) >= 3:
            yield _hash(at(i)), strings, start, end


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n: Counter = Counter()
        for text in b.column(0).to_pylist():
            for key, strings, _, _ in occurrences(text):
                n[key, strings] += 1
        keys, values = [k for k, _ in n], [v for _, v in n]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.string()), pa.array(list(n.values()), pa.int64())], names=["key", "strings", "n"])


def aligned(g: str, c: str) -> tuple[str, str] | None:
    """What differs between a garbled string and its twin once their common ends are off, if it may be a character whose bytes in UTF-8 were
    read one by one."""
    start = 0
    while start < len(c) and g[start] == c[start]:
        start += 1
    end = 0
    while end < len(c) - start and g[-1 - end] == c[-1 - end]:
        end += 1
    x, y = g[start : len(g) - end], c[start : len(c) - end]
    return (x, y) if len(y) == 1 and len(x) == len(y.encode()) and max(map(ord, x)) <= LAST_OF_PAGES and plausible(y) else None


def code_page(told: dict[str, tuple[str, int]]) -> dict[str, str]:
    """The mappings (garbled string to character, with its number of words) that agree on what character each byte was read as."""
    votes: dict[int, Counter] = {}
    for g, (c, n) in told.items():
        for byte, sign in zip(c.encode(), g, strict=True):
            votes.setdefault(byte, Counter())[sign] += n
    page = {b: v.most_common(1)[0][0] for b, v in votes.items() if v.most_common(1)[0][1] >= SURE * v.total()}
    used = Counter(page.values())
    agreed = {g: c for g, (c, _) in told.items() if all(page.get(b) == sign and used[sign] == 1 for b, sign in zip(c.encode(), g, strict=True))}
    return agreed if len(agreed) >= LEAST_MAPPINGS else {}


def _explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(garbled, clean, why) of every aligned pair of strings: why names the readings that explain it, joined by commas, or tells the mapping
    of characters that would, in which case garbled is the key of the word."""
    every = readers()
    memo: dict[tuple[str, str], str] = {}
    for b in batches:
        out: dict[tuple[str, str], str] = {}
        for key, bad, good in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
            x, y = bad.split("\x1f"), good.split("\x1f")
            if len(x) != len(y):
                continue  # not aligned one to one
            for g, c in zip(x, y, strict=True):
                if g == c:
                    continue
                if (why := memo.get((g, c))) is None:
                    why = "lost" if _LOST in g and _LOST not in c else ",".join(r.name for r in every if r.garble(c) == g)
                    if not why and len(g) > len(c) and (piece := aligned(g, c)):
                        why = "\x1f".join(("map", *piece))
                    if len(memo) < 200_000:  # memory only
                        memo[g, c] = why
                if why.startswith("map\x1f"):
                    out[str(key), why] = why
                elif why:
                    out[g, c] = why
        names = [[g for g, _ in out], [c for _, c in out], list(out.values())]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in names], names=["garbled", "clean", "why"])


def variants(documents: DataFrame, text: str = "text") -> DataFrame:
    """key, strings, n: the words with non-ASCII characters by what is left of them and their neighbours without these."""
    found = documents.select(text).filter(F.col(text).rlike(r"[^\x00-\x7f]")).mapInArrow(_count, "key bigint, strings string, n bigint")
    return materialize(found.groupBy("key", "strings").agg(F.sum("n").alias("n")), "variants")


def references(seen: DataFrame) -> DataFrame:
    """key, reference: the commonest spelling of each key that holds neither lost nor control characters."""
    clean = seen.filter(~F.col("strings").rlike("[\\x{80}-\\x{84}\\x{86}-\\x{9f}\\x{fffd}]"))
    return clean.groupBy("key").agg(F.max_by("strings", F.struct("n", "strings")).alias("reference"))


def learn(seen: DataFrame) -> tuple[dict[str, int], dict[str, str]]:
    """(readings, mappings). The readings that explain how clean twins turned into garbled ones, with the number of different pairs of strings
    that each explains and those before it don't: many readings agree on some characters, so the one that explains most comes first.
    The mappings, garbled characters to clean ones, are inferred from aligned pairs that no reading of the catalogue explains.

    Only the numbers of pairs per set of readings reach the driver, which the catalogue bounds, and mappings of single characters.
    """
    pairs = seen.join(references(seen), "key").filter(F.col("strings") != F.col("reference")).select("key", "strings", "reference").distinct()
    explained = materialize(pairs.mapInArrow(_explain, "garbled string, clean string, why string").distinct(), "explained")
    counted = explained.groupBy("why").agg(F.count(F.lit(1)).alias("n"))
    mapped = F.startswith(F.col("why"), F.lit("map\x1f"))
    part = F.split("why", "\x1f")
    told = counted.filter(mapped).select(part[1].alias("garbled"), part[2].alias("clean"), "n").groupBy("garbled").agg(F.max_by("clean", "n").alias("clean"), F.max("n").alias("n"), F.sum("n").alias("all"))
    sure = told.filter((F.col("n") >= LEAST_WORDS) & (F.col("n") >= SURE * F.col("all")))
    mappings = code_page({r.garbled: (r.clean, r.n) for r in sure.collect()})  # single characters
    sets = {frozenset(r.why.split(",")): r.n for r in counted.filter(~mapped).collect()}
    order = {r.name: -i for i, r in enumerate(readers())} | {"lost": 1}
    chosen: dict[str, int] = {}
    while sets:
        votes: Counter = Counter()
        for names, n in sets.items():
            for name in names:
                votes[name] += n
        best = max(votes, key=lambda x: (votes[x], order[x]))
        if votes[best] < LEAST_PAIRS:
            break
        chosen[best] = votes[best]
        sets = {names: n for names, n in sets.items() if best not in names}
    return chosen, mappings


class Restorer:
    def __init__(self, names: list[str], mappings: dict[str, str] | None = None):
        every = readers(names)
        self.mappings = mappings or {}
        piece = "|".join(map(re.escape, sorted(self.mappings, key=len, reverse=True)))
        # no letters beyond ASCII but mapped ones stand beside them, so that words of another alphabet stay
        self.mapped = re.compile(rf"(?<![^\W\d_a-zA-Z])(?:{piece})+(?![^\W\d_a-zA-Z])") if piece else None
        self.piece = re.compile(piece) if piece else None
        self.bytewise = [r for r in every if r.pattern is None]
        self.readers = [r for r in every if r.pattern is not None]
        latin = ("utf-8>latin-1", "utf-8>iso8859-15")
        self.latin_first = sorted(self.readers, key=lambda r: r.name not in latin)
        self.gate = re.compile("|".join(r.gate.pattern for r in self.readers)) if self.readers else None
        self.memo: dict[tuple[str, bool], str] = {}

    def whole(self, s: str, latin: bool) -> str:
        """The string by the first reading that explains all of it, or as it is."""
        got = self.memo.get((s, latin))
        if got is None:
            got = next((x for r in (self.latin_first if latin else self.readers) if (x := r.whole(s))), s)
            if len(s) <= 64 and len(self.memo) < 100_000:  # memory only
                self.memo[s, latin] = got
        return got

    def restore(self, text: str) -> tuple[str, bool]:
        """The text put right as far as possible, and whether it is garbled anywhere."""
        if not _GATE.search(text):
            return text, False
        out = text
        if _CONTROL.search(text):
            out = _CUT.sub("\xa0", _SINGLE.sub(_japanese, out))
        latin = bool(_LATIN.search(text))
        order = self.latin_first if latin else self.readers
        for r in self.bytewise:
            out = r.restore(out)
        while True:  # each round that changes anything makes the text shorter
            before = out
            out = _FOREIGN.sub(lambda m: self.whole(m[0], latin), out)
            if self.gate and self.gate.search(out):
                for r in order:
                    out = r.restore(out)
            if self.mapped:
                out = self.mapped.sub(lambda m: self.piece.sub(lambda x: self.mappings[x[0]], m[0]), out)
            if out == before:
                break
        return out, out != text or _LOST in text or _CONTROL.search(out) is not None


#: Control characters that only readers of ISO 8859 leave.
_LATIN = re.compile("[\x80\x82-\x84\x86-\x8c\x8e\x91-\x9c\x9e\x9f]")
#: Strings of characters that cp1252 has, line by line.
_SINGLE = re.compile("[^\n\u0100-\U0010ffff]*(?:[" + "".join(c for c in alphabet("cp1252") if ord(c) > 255) + "][^\n\u0100-\U0010ffff]*)*")
_BYTE = {c: b for b, c in reversed(list(enumerate(alphabet("cp1252"))))}
#: A no-break space that ended a character of three bytes and was made a blank later.
_CUT = re.compile("(?<=[\xe0-\xef][\x80-\x9f]) ")


def _japanese(m: re.Match) -> str:
    """Shift-JIS read as cp1252, put right. Its bytes fall into ASCII too, so twins don't show this reading; control characters
    show that something was read wrongly, and only a string that is whole in Shift-JIS, isn't in UTF-8 and gives kana is taken."""
    if not _CONTROL.search(m[0]):
        return m[0]
    b = bytes([_BYTE.get(c, ord(c) & 255) for c in m[0]])
    try:
        b.decode("utf-8")
        return m[0]
    except UnicodeDecodeError:
        pass
    try:
        r = b.decode("cp932")
    except UnicodeDecodeError:
        return m[0]
    other = len(_FOREIGN.sub("", r))
    kana = len(re.findall("[\u3041-\u30ff]", r))
    return r if 3 * kana >= len(r) - other > 0 else m[0]


def garbled(documents: DataFrame, key: str = "doc_id", text: str = "text", fill_lost: bool = True) -> DataFrame:
    """key, garbled text, restored text: one row per document with at least one garbled passage.

    1. Each word with non-ASCII characters is joined with its near-twins: words with the same ASCII letters between neighbours
       with the same ASCII letters, digits aside. Of the spellings of such a group the commonest one without lost or control
       characters is the clean twin.
    2. The non-ASCII strings of a word and its twin are aligned one to one; a reading of the catalogue that turns the clean string
       into the garbled one is learned if different pairs show it. What no reading explains is aligned by characters: strings that
       stand for one character in nearly all words with a twin, and agree on an unknown code page, become mappings of their own.
    3. What was learned is applied to all text, however long, until nothing changes (text read wrongly several times), wherever the
       result is plausible; so words without a twin, and scripts without ASCII letters, are restored too.
    4. Characters that were lost (U+FFFD) are filled from the twin of the word, where there is one. Control characters
       (C1) and lost ones that stay mark the document as garbled all the same.

    Null, empty and ASCII texts are never garbled, nor are rightly accented ones. Repeated documents come out repeatedly. Few
    documents teach little: without twins only lost and control characters are found. An empty table gives no rows.
    """
    seen = variants(documents, text)
    learned, mappings = learn(seen)
    names = list(learned)
    schema = T.StructType([documents.schema[key], T.StructField(text, T.StringType()), T.StructField("restored", T.StringType())])
    out_names = [key, text, "restored"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(names, mappings)
        for b in batches:
            take, restored = [], []
            for i, s in enumerate(b.column(1).to_pylist()):
                r, bad = restorer.restore(s)
                if bad:
                    take.append(i)
                    restored.append(r)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(restored, pa.string())], names=out_names)

    bad = documents.select(key, text).filter(F.col(text).rlike(r"[^\x00-\x7f]")).mapInArrow(run, schema)
    return _filled(bad, references(seen), key, text) if fill_lost else bad


def _filled(bad: DataFrame, twins: DataFrame, key: str, text: str) -> DataFrame:
    """``bad`` with lost characters taken from the twins."""
    bad = materialize(bad.withColumn("_row", F.monotonically_increasing_id()), "garbled")

    def holes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for row, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                last = -1
                for k, strings, start, _ in occurrences(s):
                    nth, last = int(start == last), start
                    if _LOST in strings:
                        for column, x in zip(out, (row, k, start, strings, nth), strict=True):
                            column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["_row", "key", "at", "strings", "nth"])

    lost = bad.filter(F.col("restored").contains(_LOST)).select("_row", "restored").mapInArrow(holes, "_row bigint, key bigint, at bigint, strings string, nth int")
    fills = lost.join(twins, "key").groupBy("_row").agg(F.collect_list(F.struct("at", "nth", "strings", "reference")).alias("fills"))  # as many as the text has holes

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for s, fs in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                best = {f["at"]: f for f in sorted(fs or [], key=lambda f: -f["nth"])}  # the twin with its neighbours before the word alone
                for f in sorted(best.values(), key=lambda f: -f["at"]):
                    x, y = f["strings"].split("\x1f"), f["reference"].split("\x1f")
                    if len(x) == len(y):
                        end = _ASCII_WORD.match(s, f["at"]).end()
                        parts = iter(y)
                        s = s[: f["at"]] + _FOREIGN.sub(lambda m: next(parts), s[f["at"] : end]) + s[end:]
                done.append(s)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(done, pa.string())], names=[key, text, "restored"])

    joined = bad.join(fills, "_row", "left").select(key, text, "restored", "fills")
    return joined.mapInArrow(fill, T.StructType([f for f in bad.schema.fields if f.name != "_row"]))
