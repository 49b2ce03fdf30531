"""Text primitives: native column expressions, and the Python forms of the few that Spark can't express."""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_table() -> tuple[str, str]:
    """Single characters whose compatibility decomposition is one base character (accents, width and style forms), and these bases."""
    source, target = [], []
    for o in (*range(0xA0, 0x250), *range(0x386, 0x400), *range(0x400, 0x500), *range(0x1E00, 0x2000), *range(0x2070, 0x20A0), *range(0xFF01, 0xFF5F)):
        c = chr(o)
        base = "".join(x for x in unicodedata.normalize("NFD", unicodedata.normalize("NFKC", c)) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            source.append(c)
            target.append(base)
    return "".join(source), "".join(target)


_FROM, _TO = _latin_table()
#: Ligatures and signs that stand for several letters (fixed values).
_SEVERAL = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "™": "TM", "℠": "SM", "№": "No", "…": "...", "½": "1⁄2", "¼": "1⁄4", "¾": "3⁄4", "ĳ": "ij"}
_CONTROLS = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]"


def collapse(c: Column) -> Column:
    """Control characters and runs of white space (no-break spaces too) to one blank, trimmed."""
    return F.trim(F.regexp_replace(c, f"(?U)(?:\\s|{_CONTROLS})+", " "))


def deaccent(c: Column) -> Column:
    """Base letters: compatibility forms folded, combining marks dropped."""
    for k, v in _SEVERAL.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return F.regexp_replace(F.translate(c, _FROM, _TO), "\\p{Mn}+", "")


def match_key(c: Column) -> Column:
    """Comparison key without case, accents and punctuation."""
    return F.trim(F.regexp_replace(F.lower(deaccent(c)), "[^\\p{L}\\p{N}\\p{M}]+", " "))


def tight_key(c: Column) -> Column:
    return F.replace(match_key(c), F.lit(" "), F.lit(""))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]{0,400}>", " ")


def number_in(c: Column) -> Column:
    """The first number, commas ignored; null without one."""
    return F.nullif(F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), "-?\\d+(?:\\.\\d+)?", 0), F.lit("")).try_cast("double")


def binned(n: Column, bins: list) -> Column:
    """Label of the first [label, low, high] that holds n, bounds included, null for no bound; null outside all."""
    out = None
    for label, low, high in bins:
        test = F.lit(True) & n.isNotNull()
        if low is not None:
            test = test & (n >= float(low))
        if high is not None:
            test = test & (n <= float(high))
        out = F.when(test, F.lit(str(label))) if out is None else out.when(test, F.lit(str(label)))
    return F.lit(None).cast("string") if out is None else out


def accent_score(c: Column) -> Column:
    """Letters beyond ASCII; -1 where the text looks read in a wrong encoding."""
    return F.when(c.rlike("[Ãã][\\x{80}-\\x{BF}\\x{A1}-\\x{FF}]"), -1).otherwise(F.length(F.regexp_replace(c, "[\\x00-\\x7F]", "")))


# Python forms, for operators that need Python anyway


def py_collapse(s: str) -> str:
    return " ".join(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ", s).split())


def py_key(s: str) -> str:
    folded = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", s))
    letters = (c for c in folded if unicodedata.category(c) != "Mn")
    return " ".join("".join(c if c.isalnum() else " " for c in "".join(letters).lower()).split())


def py_unescape(s: str) -> str:
    """Tags dropped, then character references resolved, so that escaped tags survive."""
    return html.unescape(re.sub(r"<[^>]{0,400}>", " ", s)) if "<" in s or "&" in s else s


_GARBLED = re.compile("[Ãã][\x80-\xbf\xa1-\xff]")


def py_repair(s: str) -> str:
    """UTF-8 that was read as cp1252, put right where that is possible for the whole value."""
    if not _GARBLED.search(s):
        return s
    try:
        return s.encode("cp1252").decode("utf-8")
    except UnicodeError:
        return s


def py_clean(s: str) -> str:
    return py_collapse(py_unescape(py_repair(unicodedata.normalize("NFKC", s))))


def tidy_values(col: Column) -> Column:
    """Values with white space collapsed, without nulls and empty ones."""
    return F.filter(F.transform(col, collapse), lambda v: v.isNotNull() & (v != ""))
