"""String measures shared by the operators of this subpackage; pure functions of short strings."""

from __future__ import annotations

import re
import unicodedata

_WORD = re.compile(r"[^\W_]+")
_MARKS = {c: None for c in range(0x300, 0x370)}
#: Letters that decomposition leaves alone (fixed values).
_PLAIN = str.maketrans({"ß": "ss", "ø": "o", "ł": "l", "đ": "d", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th", "ð": "d"})


def fold(s: str) -> str:
    """Case-folded compatibility form without accents."""
    if s.isascii():
        return s.lower()
    return unicodedata.normalize("NFD", unicodedata.normalize("NFKC", s).lower()).translate(_MARKS).translate(_PLAIN)


def tokens(s: str) -> list[str]:
    """Runs of letters and digits of the folded text."""
    return _WORD.findall(fold(s))


def edits(a: str, b: str, most: int = 2) -> int:
    """Optimal string alignment distance (insert, delete, replace, swap of neighbours); most + 1 when it is more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def subsequence(short: str, long: str) -> bool:
    """Whether the letters of short occur in long in this order."""
    it = iter(long)
    return all(c in it for c in short)


def lcs_ratio(a: str, b: str) -> float:
    """Length of the longest common subsequence, twice, over both lengths (0 for two empty strings). Bit-parallel rows."""
    if not a or not b:
        return 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = (s + u | s - u) & full
    return 2 * (len(a) - s.bit_count()) / (len(a) + len(b))


class DeletionIndex:
    """Words by what remains of them after up to ``depth`` deletions: finds all words within ``depth`` edits without scanning.

    What remains of a word grows with a power of its length, so words of more than LONG letters are compared with the index words of
    about their length instead, with the same result.
    """

    LONG = 40

    def __init__(self, words, depth: int = 2):
        self.depth = depth
        self.by: dict[str, set[str]] = {}
        self.by_length: dict[int, list[str]] = {}
        for w in set(words):
            self.by_length.setdefault(len(w), []).append(w)
            if len(w) <= self.LONG + depth:
                for v in self.variants(w):
                    self.by.setdefault(v, set()).add(w)

    def variants(self, w: str) -> set[str]:
        out = level = {w}
        for _ in range(min(self.depth, max(0, len(w) - 1))):
            level = {x[:i] + x[i + 1 :] for x in level for i in range(len(x))}
            out = out | level
        return out

    def near(self, w: str) -> dict[str, int]:
        """Words of the index within depth edits of w, with their distance."""
        if len(w) > self.LONG:
            found = {x for n in range(len(w) - self.depth, len(w) + self.depth + 1) for x in self.by_length.get(n, ())}
        else:
            found = set().union(*(self.by.get(v, ()) for v in self.variants(w)))
        return {x: d for x in found if (d := edits(w, x, self.depth)) <= self.depth}
