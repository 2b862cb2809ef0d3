"""Numbers of announcements (NN/YYYY) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sondar.functions import text as T

#: Number and four-digit year of an announcement; no part of a date or of the number of a law (fixed pattern).
KEY = r"(?<![0-9./])([0-9]{1,4})\s*[/\-]\s*(20[12][0-9])\b"
#: The same with a two-digit year, after a word that says what is numbered (fixed pattern).
SHORT = r"(?i)(?:edital|concursos?|processos?\s+seletiv\w*|sele[cç][aã]o|\bpss\b|\bn(?:[º°]|o)?\b)[^0-9]{0,24}?(?<![0-9./])([0-9]{1,4})\s*[/\-]\s*([0-9]{2})\b(?!\s*[/\-]\s*[0-9]{2,4}\b)"
#: Any number and year that no further part of a date follows (fixed pattern).
LABEL = r"([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})(?![0-9])(?!\s*[/.\-]\s*[0-9])"
ITEM = r"(?:edital|concurso|processo|retificacao|convocacao|certame)[^0-9\n]{0,20}[0-9]{1,4}/[0-9]{4}"
_PREFIX = r"(?:n(?:º|ş|o|\.)|numero|número|nÃºmero|nĂşmero)"
#: Where a text names its number, in order (fixed patterns).
NAMED = (
    r"(?i)(?:edital|ato|certame|concurso|processo seletivo|pss)[^0-9]{0,30}([0-9]{1,4}\s*[/.\-]\s*(?:20)?[0-9]{2})(?![0-9])(?!\s*[/.\-]\s*[0-9])",
    r"(?i)" + _PREFIX + r"\s*([0-9]{1,4}\s*[/.\-]\s*(?:20)?[0-9]{2})(?![0-9])(?!\s*[/.\-]\s*[0-9])",
)
LOOSE = r"(?is)" + _PREFIX + r"\s*([0-9]{1,4})(?!\s*[/.\-]).{0,120}?(20[0-9]{2})"
#: Ordered patterns on the match form (fixed patterns).
PARTS = (r"(?:edital\s*)?(?:n[o.]*)\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})", r"\b([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})\b")
TITLED = (
    r"edital\s+(?:de\s+abertura\s+)?(?:do\s+concurso\s+publico\s+)?(?:n[o.]*)\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})",
    r"processo\s+seletivo\s+(?:simplificado\s+)?(?:n[o.]*)\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})",
    r"concurso\s+publico\s+(?:n[o.]*)\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})",
    r"\b(?:n[o.]*)\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})",
)
CONTEXT = (
    r"(?:edital|processo seletivo|concurso publico|pss)[\w\s/.\-]{0,90}?n[o.]*\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})",
    r"n[o.]*\s*([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})[\w\s/.\-]{0,90}?(?:edital|processo seletivo|concurso publico|pss)",
    r"edital\s+([0-9]{1,4})\s*[/.\-]\s*((?:20)?[0-9]{2})",
)
OWN = r"\b(?:edital|portaria|aviso|comunicad|nota|gabarito)\s*(?:n\s*\.?\s*o?\.?\s*)?(?:[0-9]{1,4}\s*-\s*)?([0-9]{1,4})\s*[/\-]\s*(20[12][0-9])\b"


def year4(y: Column) -> Column:
    """Two-digit years: up to 39 this century, else the last."""
    n = y.cast("int")
    return F.when(F.length(y) == 4, n).when(n <= 39, n + 2000).otherwise(n + 1900)


def _pair(c: Column, pattern: str, year) -> Column:
    """(number, year) by a pattern with two groups; null if it isn't found."""
    a, b = F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2)
    return F.when(F.coalesce(a != "", F.lit(False)), F.struct(a.cast("int").alias("number"), year(b).alias("year")))


def _this_century(y: Column) -> Column:
    return F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y).cast("int")


def number_key(c: Column) -> Column:
    """(number, year) of the first number with a year from 2010 to 2029 that is no date or law; else of one with a short year; fields null if there is none."""
    k = F.coalesce(_pair(c, KEY, lambda y: y.cast("int")), _pair(c, SHORT, year4))
    return F.struct(k["number"].alias("number"), k["year"].alias("year"))


def own_key(c: Column) -> Column:
    """(number, year) that a document's first line gives to the document itself; null if it gives none."""
    return _pair(T.quote_form(F.substring_index(c, "\n", 1)), OWN, lambda y: y.cast("int"))


def _label(number: Column, year: Column) -> Column:
    n = number.cast("string")
    return F.concat(F.lit("nº "), F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n), F.lit("/"), year.cast("string"))


def number_label(c: Column) -> Column:
    """`nº NN/YYYY` of the first number with a year, padded to two digits; two-digit years are this century's; null if there is none."""
    k = _pair(c, LABEL, _this_century)
    return F.when(k.isNotNull(), _label(k["number"], k["year"]))


def named_label(c: Column) -> Column:
    """`nº NN/YYYY` where a text names its number, else of a number loosely followed by a year; null if there is none."""
    found = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in NAMED]
    loose = F.when(F.regexp_extract(c, LOOSE, 1) != "", F.concat(F.regexp_extract(c, LOOSE, 1), F.lit("/"), F.regexp_extract(c, LOOSE, 2)))
    return number_label(F.coalesce(*found, loose))


def number_parts(x: Column) -> Column:
    """(number, year) of a text's match form, a labelled number first; null if there is none."""
    return F.coalesce(*[_pair(x, p, _this_century) for p in PARTS])


def parts_label(x: Column) -> Column:
    """number_parts as `nº NN/YYYY`; empty if there is none."""
    k = number_parts(x)
    return F.coalesce(F.when(k.isNotNull(), _label(k["number"], k["year"])), F.lit(""))


def same_number(a: Column, b: Column) -> Column:
    """Whether both texts, given as match forms, have a number and it is the same."""
    return F.coalesce(number_parts(a) == number_parts(b), F.lit(False))


def titled_label(x: Column) -> Column:
    """`nº NN/YYYY` of a match form by the first of the ordered title patterns that is found; empty if none is."""
    k = F.coalesce(*[_pair(x, p, _this_century) for p in TITLED])
    return F.coalesce(F.when(k.isNotNull(), _label(k["number"], k["year"])), F.lit(""))


def context_label(x: Column, year: Column | None = None) -> Column:
    """`nº NN/YYYY` of a number that a match form names together with what it numbers, of the given year if there is one; empty if there is none."""
    out = []
    for p in CONTEXT:
        pairs = F.arrays_zip(F.regexp_extract_all(x, F.lit(p), 1).alias("a"), F.regexp_extract_all(x, F.lit(p), 2).alias("b"))
        named = F.transform(pairs, lambda r: F.struct(r["a"].cast("int").alias("number"), _this_century(r["b"]).alias("year")))
        if year is not None:
            named = F.filter(named, lambda r: year.isNull() | (r["year"] == year))
        out.append(F.try_element_at(named, F.lit(1)))
    k = F.coalesce(*out)
    return F.coalesce(F.when(k.isNotNull(), _label(k["number"], k["year"])), F.lit(""))


def head_lines(c: Column, most: int = 18) -> Column:
    """The first lines of a text that aren't blank, trimmed."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[\r\n]+"), F.trim), lambda x: x != "")
    return F.array_join(F.slice(lines, 1, most), "\n")


def distinct_items(c: Column) -> Column:
    """Number of distinct announcement items named in a folded text."""
    return F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(f"({ITEM})"), 1)))
