"""Text normal forms as Column expressions; null stays null unless said otherwise."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F



def _compatible() -> tuple[str, str, dict[str, str]]:
    """(characters, their one-character forms, longer forms in ASCII), from the Unicode database.

    Letters and signs up to the number forms, ligatures, and full-width forms; of others only
    combining marks go.
    """
    src, dst, longer = [], [], {}
    for cp in (*range(0x80, 0x2190), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)):
        ch = chr(cp)
        form = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).replace("\u2044", "/")
        if form == ch:
            continue
        if len(form) == 1:
            src.append(ch)
            dst.append(form)
        elif form and form.isascii():
            longer[ch] = form
    return "".join(src), "".join(dst), longer


_ONE, _FORM, _LONGER = _compatible()
_MARKS = r"[\x{0300}-\x{036F}\x{1AB0}-\x{1AFF}\x{1DC0}-\x{1DFF}\x{20D0}-\x{20FF}\x{FE20}-\x{FE2F}]"
CONNECTORS = ("da", "de", "do", "das", "dos")
STOP = ("municipio", "municipal", "prefeitura", "camara", "concurso", "concursos", "publico", "processo", "seletivo", "edital", "para", "como", "simplificado")


def unaccent(c: Column) -> Column:
    """The compatibility form (NFKD) without combining marks: accents off, ligatures, ordinal and width forms plain.

    Forms of several characters are looked up only in texts that have any.
    """
    table = F.map_from_arrays(F.split(F.lit("\x01".join(_LONGER)), "\x01"), F.split(F.lit("\x01".join(_LONGER.values())), "\x01"))
    spelled = F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)(.)"), 1), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    x = F.translate(F.when(F.length(F.translate(c, "".join(_LONGER), "")) < F.length(c), spelled).otherwise(c), _ONE, _FORM)
    return F.regexp_replace(x, _MARKS, "")


def fold(c: Column) -> Column:
    """Accents off, lower case, every run of other characters one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(unaccent(c)), "[^a-z0-9]+", " "))


def compact(c: Column) -> Column:
    """Join key: accents off, lower case, letters and digits only."""
    return F.regexp_replace(F.lower(unaccent(c)), "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    """fold with dashes for blanks."""
    return F.regexp_replace(fold(c), " ", "-")


def slug_plain(c: Column) -> Column:
    """fold without connectors and blanks."""
    return F.array_join(F.filter(F.split(fold(c), " "), lambda w: ~w.isin(*CONNECTORS)), "")


def match_form(c: Column) -> Column:
    """Accents off, lower case, degree signs as o, blanks collapsed; punctuation stays."""
    return F.trim(F.regexp_replace(F.translate(F.lower(unaccent(c)), "°", "o"), "\\s+", " "))


def squeezed(c: Column) -> Column:
    """White space collapsed and trimmed; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def ellipsis(c: Column, limit: int, mark: str = "...") -> Column:
    """squeezed, cut to `limit` characters with a mark where it is longer."""
    x = squeezed(c)
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit), F.lit(mark))).otherwise(x)


def quote_form(c: Column) -> Column:
    """Form in which quotes are compared: ASCII letters of the compatibility form, lower case, blanks collapsed; punctuation stays.

    Text that shows the marks of UTF-8 read as Latin-1 is read again first, where all of it can be.
    """
    x = F.coalesce(c, F.lit(""))
    broken = x.rlike("[ÃÂ]") & ~x.rlike("[^\\x{00}-\\x{FF}]")
    again = F.try_validate_utf8(F.encode(x, "ISO-8859-1").cast("string"))
    x = F.when(broken, F.coalesce(again, x)).otherwise(x)
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(unaccent(x), "[^\\x{00}-\\x{7F}]", "")), r"\s+", " "))


def file_label(c: Column) -> Column:
    """Runs of characters that a file name can't have as one underscore."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_.\-]+", "_")


def cased_name(c: Column) -> Column:
    """A name written at least 72 % in capitals in title case, with small connectors and known acronyms; others as they are."""
    x = F.initcap(F.lower(c))
    x = F.array_join(F.transform(F.split(x, " "), lambda w: F.when(w.isin("De", "Da", "Das", "Do", "Dos", "E"), F.lower(w)).when(w.isin("Rs", "Crq", "Crea", "Cref", "Ufsm", "Ufrgs", "Trt", "Dpe"), F.upper(w)).otherwise(w)), " ")
    return F.when(mostly_upper(c), x).otherwise(F.coalesce(c, F.lit("")))


def identity_tokens(c: Column, least: int = 4) -> Column:
    """Distinct words of at least `least` characters that aren't stop words, in order."""
    return F.array_distinct(F.filter(F.split(fold(c), " "), lambda w: (F.length(w) >= least) & ~w.isin(*STOP)))


def mostly_upper(c: Column) -> Column:
    """Whether at least 72 % of the letters are capitals."""
    letters = F.length(F.regexp_replace(unaccent(c), "[^A-Za-z]", ""))
    return (letters > 0) & (F.length(F.regexp_replace(unaccent(c), "[^A-Z]", "")) >= 0.72 * letters)


def windows(c: Column, size: int = 14000, step: int = 12000, most: int | None = None) -> Column:
    """Array of (start, text): one window if the text fits, else overlapping ones, to the text's end or `most` of them."""
    n = F.length(c)
    starts = F.when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(step)))
    starts = starts if most is None else F.slice(starts, 1, most)
    return F.transform(starts, lambda s: F.struct(s.cast("int").alias("start"), F.substring(c, s + 1, F.lit(size)).alias("text")))


def around(c: Column, needle: str, radius: int) -> Column:
    """Text within radius of the first occurrence of a literal; null if there is none."""
    at = F.instr(c, needle)
    a = F.greatest(at - radius, F.lit(1))
    return F.when(at > 0, F.substring(c, a, at - a + len(needle) + radius))


def contains_any(c: Column, phrases: tuple[str, ...]) -> Column:
    """Whether any of the literal phrases occurs, in one pass over the text; null holds none."""
    return F.coalesce(c.rlike("|".join(re.escape(p) for p in phrases)), F.lit(False))


def holds(c: Column, phrases: tuple[str, ...]) -> Column:
    """contains_any by byte search, a pass for each phrase: quicker than a pattern where c is a column by itself."""
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(c, F.lit(p))
    return F.coalesce(out, F.lit(False))
