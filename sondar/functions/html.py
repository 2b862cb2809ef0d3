"""Fields of a page's source as Column expressions (no Python on the way)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
ANCHOR = r"""(?is)<a\s[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>"""


def unescape(c: Column) -> Column:
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def title(c: Column) -> Column:
    """Text of the first title element; empty if there is none."""
    return F.trim(unescape(F.regexp_extract(c, r"<title[^>]*>([^<]*)</title>", 1)))


def heading(c: Column) -> Column:
    return F.trim(unescape(F.regexp_extract(c, r"<h1[^>]*>([^<]*)</h1>", 1)))


def text(c: Column) -> Column:
    """Visible text: scripts, styles and tags become blanks, entities decoded, blanks collapsed."""
    c = F.regexp_replace(c, r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(c, "<[^>]*>", " ")), r"\s+", " "))


def anchors(c: Column) -> Column:
    """Array of (href, label), in order, repeated ones kept."""
    href, label = F.regexp_extract_all(c, F.lit(ANCHOR), 1), F.regexp_extract_all(c, F.lit(ANCHOR), 2)
    clean = lambda l: F.trim(F.regexp_replace(unescape(F.regexp_replace(l, "<[^>]+>", "")), r"\s+", " "))
    return F.zip_with(href, label, lambda h, l: F.struct(h.alias("href"), clean(l).alias("label")))


def absolute(href: Column, base: Column) -> Column:
    """href against the page's host; absolute ones stay, others than http and paths are null."""
    host = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    return F.when(href.rlike("^https?://"), href).when(href.startswith("/"), F.concat(host, href))


def headings(c: Column) -> Column:
    """Texts of the h1 to h4 elements, in order, tags off, of 6 to 180 characters."""
    raw = F.regexp_extract_all(c, F.lit(r"(?is)<h[1-4]\b[^>]*>(.*?)</h[1-4]>"), 1)
    clean = F.transform(raw, lambda h: F.trim(F.regexp_replace(unescape(F.regexp_replace(h, "<[^>]+>", " ")), r"\s+", " ")))
    return F.filter(clean, lambda h: F.length(h).between(6, 180))


def bare_urls(c: Column) -> Column:
    """Distinct addresses anywhere in the source, in quotes or bare, in order, without trailing punctuation."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"""https?://[^\s"'<>)]+"""), 0), lambda u: F.regexp_replace(u, r"[.,;]+$", "")))
