"""Loose JSON, redaction and differences of records as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of fields whose values are secrets (fixed values), and how a secret looks inside a text (fixed patterns).
SECRET_NAMES = ("authorization", "api_key", "apikey", "token", "access_token", "refresh_token", "password", "senha", "secret", "cookie", "set-cookie")
SECRET_TEXT = r"(?i)\b(bearer\s+)[A-Za-z0-9._~+/=-]{8,}"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def loose_object(c: Column, schema: str) -> Column:
    """The JSON object in a text that may be fenced, a list of one, or surrounded by words; null if there is none that parses."""
    body = F.regexp_replace(F.trim(c), r"^```[a-zA-Z]*\s*|\s*```$", "")
    inner = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    last = "__bad"
    got = F.from_json(inner, f"{schema}, {last} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": last})
    return F.when((inner != "") & got[last].isNull(), got.dropFields(last))


def salvaged(c: Column, schema: str, required: tuple[str, ...]) -> Column:
    """Flat JSON objects that are whole in a text cut off anywhere, in order, if they have the required fields."""
    parts = F.regexp_extract_all(c, F.lit(r"\{[^{}]*\}"), 0)
    got = F.transform(parts, lambda p: F.from_json(p, schema))

    def whole(x: Column) -> Column:
        ok = x.isNotNull()
        for f in required:
            ok = ok & x[f].isNotNull()
        return ok

    return F.filter(got, whole)


def redacted_text(c: Column) -> Column:
    """Bearer tokens in a text replaced."""
    return F.regexp_replace(c, SECRET_TEXT, "$1***")


def redacted_map(m: Column) -> Column:
    """A map with the values of secret names replaced, and bearer tokens in the others."""
    return F.transform_values(m, lambda k, v: F.when(F.lower(k).isin(*SECRET_NAMES), F.lit("***")).otherwise(redacted_text(v)))


def has_secret(c: Column) -> Column:
    """Whether a text holds a bearer token."""
    return F.coalesce(c.rlike(SECRET_TEXT), F.lit(False))


def sorted_pairs(m: Column) -> Column:
    """A map's entries in order of their names, so that equal maps are equal values; null for null."""
    return F.array_sort(F.map_entries(m))


def field_diffs(before: dict[str, Column], after: dict[str, Column], limit: int = 90) -> Column:
    """`name: 'old' -> 'new'` of each field that differs, values cut at `limit`; null counts as empty."""
    out = []
    for f, a in before.items():
        x, y = F.coalesce(a.cast("string"), F.lit("")), F.coalesce(after[f].cast("string"), F.lit(""))
        out.append(F.when(x != y, F.concat(F.lit(f"{f}: '"), F.substring(x, 1, limit), F.lit("' -> '"), F.substring(y, 1, limit), F.lit("'"))))
    return F.array_compact(F.array(*out))


def changed_names(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """Names of the fields that differ, joined by commas."""
    names = [F.when(~a.eqNullSafe(after[f]), F.lit(f)) for f, a in before.items()]
    return F.array_join(F.array_compact(F.array(*names)), ",")


def bounded(c: Column, name: str, limit: int) -> Column:
    """A text of at most `limit` characters without control characters; any other raises."""
    bad = (F.length(c) > limit) | c.rlike(CONTROL)
    return F.when(bad, F.raise_error(F.lit(f"{name}: too long, or with control characters"))).otherwise(c)


def tokens_estimate(c: Column) -> Column:
    """A quarter of a payload's characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))


def first_column(df_columns: list[str], *names: str) -> Column:
    """The first of the named columns that exists, trimmed, null as empty; empty if none exists."""
    for n in names:
        if n in df_columns:
            return F.trim(F.coalesce(F.col(n).cast("string"), F.lit("")))
    return F.lit("")
