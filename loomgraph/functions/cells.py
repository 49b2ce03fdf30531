"""Readers of typed cells: free-entered text, tidied before, to int, double, date and boolean, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.common import WHITE

#: Grams of one unit of weight (fixed values).
GRAMS = {
    "g": "1", "gr": "1", "gram": "1", "grams": "1", "kg": "1000", "kgs": "1000", "kilogram": "1000", "kilograms": "1000",
    "mg": "0.001", "oz": "28.349523125", "ounce": "28.349523125", "ounces": "28.349523125",
    "lb": "453.59237", "lbs": "453.59237", "pound": "453.59237", "pounds": "453.59237",
}
#: Month names by their first three letters (fixed values).
MONTHS = {m: f"{i:02d}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
TRUE, FALSE = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")


def tidy(c: Column) -> Column:
    """White space of any kind to one blank, trimmed, in lower case."""
    return F.lower(F.trim(F.regexp_replace(F.translate(c, WHITE, " " * len(WHITE)), " +", " ")))


def _group(c: Column, pattern: str, i: int = 1) -> Column:
    """The group, or null where the pattern or the group doesn't match."""
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def _int(c: Column) -> Column:
    return c.try_cast("bigint")


def read_count(c: Column) -> Column:
    """``1,214 pp``, ``approx. 32 pages``, ``351``: a comma divides thousands."""
    n = _group(c, r"^(?:(?:approx|about|ca|circa)\.? |~ ?)?(\d{1,3}(?:,\d{3})+|\d+) ?(?:pages?|pgs?\.?|pp?\.?|seiten)?$")
    return _int(F.replace(n, F.lit(","), F.lit("")))


def read_minutes(t: Column) -> Column:
    """``1:22:00`` (hours first), ``PT3H22M``, ``2 hours and 44 minutes``, ``48 min``, ``203``."""
    clock = r"^(\d{1,3}):([0-5]\d)(?::[0-5]\d)?$"
    words = r"^(?:pt ?)?(?:(\d+) ?h(?:ours?|rs?\.?)?)?(?:,? ?(?:and )?(\d+) ?m(?:in(?:ute)?s?\.?)?)?$"
    zero = lambda x: F.coalesce(_int(x), F.lit(0))
    return (
        F.when(t.rlike(clock), _int(_group(t, clock)) * 60 + _int(_group(t, clock, 2)))
        .when(t.rlike(words) & t.rlike(r"\d"), zero(_group(t, words)) * 60 + zero(_group(t, words, 2)))
        .otherwise(_int(_group(t, r"^(\d+)$")))
    )


def read_grams(t: Column) -> Column:
    """``5.57 kg``, ``1,83lb``, ``76,3 Oz``, ``2158``: a comma is a decimal sign, a bare number is in grams. DECIMAL, exact."""
    pattern = r"^(\d+(?:[.,]\d+)?) ?([a-z]*)\.?$"
    unit = _group(t, pattern, 2)
    factor = F.when(t.rlike(pattern) & unit.isNull(), F.lit("1"))
    for u, grams in GRAMS.items():
        factor = factor.when(unit == u, F.lit(grams))
    number = F.translate(_group(t, pattern), ",", ".")
    return number.try_cast("decimal(16,4)") * factor.try_cast("decimal(16,9)")


def read_money(t: Column) -> Column:
    """``US$1,059.19``, ``2.064,90 $``, ``17,67``: there are always two decimals, whatever the separators. DECIMAL(18,2)."""
    pattern = r"^(?:us ?\$|usd|\$)? ?(\d+(?:[.,]\d{3})*)[.,](\d{2}) ?(?:us ?\$|usd|\$)?$"
    whole = F.translate(_group(t, pattern), ",.", "")
    return F.concat(whole, F.lit("."), _group(t, pattern, 2)).try_cast("decimal(18,2)")


def read_date(t: Column) -> Column:
    """ISO, compact, ``yyyy/MM/dd``, ``dd.MM.yyyy``, ``MM/dd/yyyy`` and dates with an English month name. Impossible days are null."""
    forms = [
        (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", (1, 2, 3)),
        (r"^(\d{4})(\d{2})(\d{2})$", (1, 2, 3)),
        (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", (3, 2, 1)),
        (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 1, 2)),
        (r"^([a-z]{3})[a-z]*\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})$", (3, 1, 2)),
        (r"^(\d{1,2})(?:st|nd|rd|th)?\.? ([a-z]{3})[a-z]*\.?,? (\d{4})$", (3, 2, 1)),
    ]
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    out = None
    for pattern, (y, m, d) in forms:
        month = F.regexp_extract(t, pattern, m)
        if "[a-z]{3}" in pattern:
            month = F.try_element_at(months, month)
        made = F.concat_ws("-", F.regexp_extract(t, pattern, y), F.lpad(month, 2, "0"), F.lpad(F.regexp_extract(t, pattern, d), 2, "0"))
        made = F.when(month.isNotNull(), made)
        out = F.when(t.rlike(pattern), made) if out is None else out.when(t.rlike(pattern), made)
    return out.try_cast("date")


def read_boolean(t: Column) -> Column:
    return F.when(t.isin(*TRUE), True).when(t.isin(*FALSE), False)


def cell_reader(data_type: str, unit: str | None):
    """(reader of a text column as written and tidied to its canonical cell text, Spark type of the wide column).

    An unreadable value gives null.

    Cells are written as digits (int), with two decimals (USD), one decimal half up (g), ``yyyy-MM-dd``, ``true``/``false``;
    a string cell is the value as written unless it is blank.
    """
    if data_type == "int":
        reader = read_minutes if unit == "minutes" else read_count
        return (lambda c, t: reader(t).cast("string")), "bigint"
    if data_type == "double" and unit == "g":
        return (lambda c, t: F.round(read_grams(t), 1).cast("decimal(18,1)").cast("string")), "double"
    if data_type == "double":
        return (lambda c, t: read_money(t).cast("string")), "double"
    if data_type == "date":
        return (lambda c, t: read_date(t).cast("string")), "date"
    if data_type == "boolean":
        return (lambda c, t: read_boolean(t).cast("string")), "boolean"
    return (lambda c, t: F.when(t != "", c)), "string"
