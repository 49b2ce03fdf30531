"""Mapping free-entered values to a canonical list: a multi-pattern automaton first, token-set similarity for the rest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomgraph.llm.strings import DeletionIndex, fold, subsequence, tokens

#: Values of these words name nothing (fixed values).
PLACEHOLDERS = "n/a na none null nil unknown other others various varies tbd see label|see picture|see packaging|see text|as shown|standard|imported|mixed|misc|default|generic|assorted items"
#: Countries and unions that are told apart from similar names of a list of countries; one that is in the list is dropped here (fixed values).
COUNTRIES = """Afghanistan|Albania|Algeria|Andorra|Angola|Argentina|Armenia|Australia|Austria|Azerbaijan|Bahamas|Bahrain|Bangladesh|Barbados|Belarus|Belgium|Belize|Benin|Bhutan|Bolivia|Bosnia|Botswana|Brazil|Brunei|Bulgaria|Burkina Faso|Burundi|Cambodia|Cameroon|Canada|Cape Verde|Chad|Chile|China|Colombia|Comoros|Congo|Costa Rica|Croatia|Cuba|Cyprus|Czechia|Denmark|Djibouti|Dominica|Dominican Republic|Ecuador|Egypt|El Salvador|Equatorial Guinea|Eritrea|Estonia|Eswatini|Ethiopia|European Union|EU|Fiji|Finland|France|Gabon|Gambia|Georgia|Germany|Ghana|Greece|Grenada|Guatemala|Guinea|Guinea-Bissau|Guyana|Haiti|Honduras|Hungary|Iceland|India|Indonesia|Iran|Iraq|Ireland|Israel|Italy|Ivory Coast|Jamaica|Japan|Jordan|Kazakhstan|Kenya|Kiribati|Kosovo|Kuwait|Kyrgyzstan|Laos|Latvia|Lebanon|Lesotho|Liberia|Libya|Liechtenstein|Lithuania|Luxembourg|Madagascar|Malawi|Malaysia|Maldives|Mali|Malta|Mauritania|Mauritius|Mexico|Micronesia|Moldova|Monaco|Mongolia|Montenegro|Morocco|Mozambique|Myanmar|Namibia|Nauru|Nepal|Netherlands|New Zealand|Nicaragua|Niger|Nigeria|North Korea|North Macedonia|Norway|Oman|Pakistan|Palau|Panama|Papua New Guinea|Paraguay|Peru|Philippines|Poland|Portugal|Qatar|Romania|Russia|Rwanda|Samoa|San Marino|Saudi Arabia|Senegal|Serbia|Seychelles|Sierra Leone|Singapore|Slovakia|Slovenia|Somalia|South Africa|South Korea|South Sudan|Spain|Sri Lanka|Sudan|Suriname|Sweden|Switzerland|Syria|Taiwan|Tajikistan|Tanzania|Thailand|Togo|Tonga|Tunisia|Turkmenistan|Uganda|Ukraine|United Arab Emirates|United Kingdom|United States|Uruguay|Uzbekistan|Vanuatu|Vatican City|Venezuela|Vietnam|Yemen|Zambia|Zimbabwe"""
#: A value fits an entry from this similarity on.
LEAST = 0.68
#: Similarity of an abbreviation (``stnls``, ``boro.``) and its word.
ABBREVIATED = 0.75


def _allowed(n: int) -> int:
    """Edits that a word of n letters may have."""
    return 0 if n < 3 else 1 if n < 6 else 2


class Mapper:
    """The entries and known terms of one relation."""

    def __init__(self, names: list[tuple[str, int]], others: list[str]):
        """names: (name or term, id); others: names that are no entry and stand for id 0."""
        import ahocorasick

        self.names: dict[tuple[str, ...], int] = {}
        for name, i in names:
            if t := tuple(tokens(name)):
                self.names.setdefault(t, i)
        own = {"".join(t) for t in self.names}
        for name in others:
            if (t := tuple(tokens(name))) and "".join(t) not in own:
                self.names.setdefault(t, 0)
        self.automaton = ahocorasick.Automaton()
        for t, i in self.names.items():
            self.automaton.add_word(f" {' '.join(t)} ", (len(t), sum(map(len, t)), i))
        self.automaton.make_automaton()
        self.glued = {}
        for t, i in self.names.items():
            self.glued.setdefault("".join(t), i)
        self.many = {"".join(t) for t in self.names if len(t) > 1}
        self.initials: dict[str, int] = {}
        for t, i in self.names.items():
            if len(t) > 1:
                self.initials.setdefault("".join(w[0] for w in t), i)
        self.sorted = {}
        for t, i in self.names.items():
            self.sorted.setdefault(tuple(sorted(t)), i)
        self.near_glued = DeletionIndex(self.glued)
        self.holders: dict[str, list[tuple[str, ...]]] = {}
        for t in self.names:
            for w in t:
                self.holders.setdefault(w, []).append(t)
        self.near_word = DeletionIndex(self.holders)
        self.by_initial: dict[str, list[str]] = {}
        for w in self.holders:
            self.by_initial.setdefault(w[0], []).append(w)

    def mentions(self, words: list[str]) -> list[tuple[int, int]]:
        """(letters, id) of the names embedded as whole words: the longest first, those that overlap a longer one left out."""
        text = f" {' '.join(words)} "
        hits = [(n, end - n - k, end, i) for end, (k, n, i) in self.automaton.iter(text)]  # n letters, k - 1 blanks inside and two around
        hits.sort(key=lambda h: (-h[0], h[1]))
        taken: list[tuple[int, int]] = []
        out = []
        for n, start, end, i in hits:
            if all(end <= s + 1 or start >= e - 1 for s, e in taken):  # neighbours share the blank between them
                taken.append((start, end))
                out.append((n, i))
        return out

    def similar(self, words: list[str]) -> int:
        """The id of the most similar name, 0 if none is similar enough; of equal ones the smallest positive id."""
        best: dict[int, float] = {}

        def offer(i: int, s: float) -> None:
            if s > best.get(i, 0):
                best[i] = s

        whole = "".join(words)
        for g, d in self.near_glued.near(whole).items():
            if d <= (1 if len(words) > 1 and g in self.many and max(len(g), len(whole)) < 9 else _allowed(max(len(g), len(whole)))):
                offer(self.glued[g], 1 - d / max(len(g), len(whole)) + (0.02 if g[0] == whole[0] else 0))
        like: dict[str, dict[int, float]] = {}  # word of a name -> similarity to each word of the value
        for k, w in enumerate(words):
            for x, d in self.near_word.near(w).items():
                if d <= _allowed(max(len(x), len(w))):
                    like.setdefault(x, {})[k] = 1 - d / max(len(x), len(w))
            for x in self.by_initial.get(w[0], ()):
                if len(w) < len(x) and (x.startswith(w) and (len(w) >= 3 or len(words) > 1) or len(w) >= 3 and 2 * len(w) >= len(x) and subsequence(w, x)):
                    like.setdefault(x, {})[k] = max(like.get(x, {}).get(k, 0), ABBREVIATED if len(w) >= 3 else 0.6)
                elif 4 <= len(x) < len(w) <= len(x) + 3 and w.startswith(x[:-1]):  # derived: blackish, silvery
                    like.setdefault(x, {})[k] = max(like.get(x, {}).get(k, 0), ABBREVIATED)
        letters = sum(map(len, words)) or 1
        for t in {t for x in like for t in self.holders[x]}:
            free, total, used = set(range(len(words))), 0.0, 0
            for x in sorted(t, key=lambda x: -max(like.get(x, {0: 0}).values())):
                k = max((k for k in like.get(x, {}) if k in free), key=lambda k: like[x][k], default=None)
                if k is not None:
                    free.discard(k)
                    total += like[x][k] * len(x)
                    used += len(words[k])
            share = total / sum(map(len, t))
            if len(t) > 1 and 0.6 <= share < LEAST and len(words) == 1 and words[0] in t and len(self.holders[words[0]]) == 1:
                share = LEAST  # the word that tells this name from all others
            offer(self.names[t], share * (0.85 + 0.15 * used / letters))
        if not best:
            return 0
        i, s = max(best.items(), key=lambda x: (x[1], x[0] == 0, -x[0]))
        return i if s >= LEAST else 0

    def find(self, value: str) -> int:
        words = tokens(value)
        if not words:
            return 0
        if len(words) > 1 and all(len(w) == 1 for w in words) and "".join(words) not in self.glued:
            return self.initials.get("".join(words), 0)
        if got := self.mentions(words):
            return got[0][1]
        if (g := "".join(words)) in self.glued:
            return self.glued[g]
        if (t := tuple(sorted(words))) in self.sorted:
            return self.sorted[t]
        return self.similar(words)


def mappers(canon: list[tuple], terms: list[tuple]) -> dict[str, Mapper]:
    """By relation. canon: (canonical_id, relation, canonical); terms: (relation, term, canonical_id)."""
    names: dict[str, list[tuple[str, int]]] = {}
    for i, relation, name in sorted(c for c in canon if None not in c):
        names.setdefault(relation, []).append((name, i))
    for relation, term, i in sorted(t for t in terms if None not in t):
        if relation in names:
            names[relation].append((term, i))
    countries = COUNTRIES.split("|")
    world = {fold(c) for c in countries}
    out = {}
    for relation, own in names.items():
        others = [w for p in PLACEHOLDERS.split("|") for w in ([p] if " " in p and not p.startswith("n/a") else p.split())]
        if 2 * sum(fold(n) in world for n, _ in own) > len({i for _, i in own}):  # a list of countries
            others += countries
        out[relation] = Mapper(own, others)
    return out


def map_values(triples: DataFrame, canon: DataFrame, terms: DataFrame) -> DataFrame:
    """``triples`` with canonical_id (BIGINT): the entry of canon that the value means, 0 where none of its relation fits.

    Only rows whose relation is in canon and whose value is not null come out; an entry written as in the list maps to
    itself. An empty, blank or placeholder value, and one without letters or digits, maps to 0. Repeated rows stay
    repeated. Of several mentions the longest counts, of equally long ones the first; of equally similar entries the one
    with the smallest id. Whole values are read, of any length. An empty list gives no rows. Other columns pass through, a
    column canonical_id is replaced. Rows aren't shuffled: each task maps each distinct value of a batch once.

    canon (canonical_id, relation, canonical) and terms (relation, term, canonical_id) are reference lists of fixed size.
    """
    lists = [tuple(r) for r in canon.select("canonical_id", "relation", "canonical").collect()]
    known = [tuple(r) for r in terms.select("relation", "term", "canonical_id").collect()]
    exact = {(r, c): i for i, r, c in reversed(sorted(x for x in lists if None not in x))}
    triples = triples.drop("canonical_id")
    schema = T.StructType([*triples.schema.fields, T.StructField("canonical_id", T.LongType(), False)])
    relations = sorted({r for r, _ in exact})
    if not relations:
        return triples.sparkSession.createDataFrame([], schema)
    shared = triples.sparkSession.sparkContext.broadcast((lists, known, exact))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, known, exact = shared.value
        by = mappers(lists, known)
        memo: dict[tuple[str, str], int] = {}
        for b in batches:
            keys = zip(b.column(b.schema.get_field_index("relation")).to_pylist(), b.column(b.schema.get_field_index("value")).to_pylist(), strict=True)
            ids = []
            for key in keys:
                if (i := memo.get(key)) is None:
                    i = exact[key] if key in exact else by[key[0]].find(key[1])
                    if len(key[1]) < 200 and len(memo) < 500_000:  # memory only
                        memo[key] = i
                ids.append(i)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.int64())], names=[*b.schema.names, "canonical_id"])

    from pyspark.sql import functions as F

    return triples.filter(F.col("relation").isin(relations) & F.col("value").isNotNull()).mapInArrow(run, schema)
