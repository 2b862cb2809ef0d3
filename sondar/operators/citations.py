"""Literal citations against content-addressed snapshots, and the gates built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def occurrences(text: Column, quote: Column) -> Column:
    """Number of occurrences that don't overlap; an empty quote has none."""
    gone = F.length(text) - F.length(F.replace(text, quote, F.lit("")))
    return F.when(F.length(quote) > 0, (gone / F.length(quote)).cast("int")).otherwise(0)


def anchored(text: Column, quote: Column) -> Column:
    """(start, end, reason): offsets of a quote that occurs once; else why there are none."""
    n = occurrences(text, quote)
    reason = F.when(text.isNull() | (text == ""), "empty_source").when(n == 0, "quote_not_found").when(n > 1, "quote_ambiguous")
    start = F.when(reason.isNull(), F.instr(text, quote) - 1)
    return F.struct(start.alias("start"), (start + F.length(quote)).alias("stop"), reason.alias("reason"))


def verified(text: Column, start: Column, stop: Column, quote: Column) -> Column:
    """Null if the text between the offsets is the quote, else the reason, which tells a wrong place from a quote that isn't there."""
    bad = start.isNull() | stop.isNull() | (start < 0) | (stop > F.length(text)) | (stop <= start)
    elsewhere = F.when(F.contains(text, quote), "offset_quote_mismatch").otherwise("quote_not_found")
    return F.when(text.isNull() | (text == ""), "empty_source").when(bad, "offset_out_of_bounds").when(F.substring(text, start + 1, stop - start) != quote, elsewhere)


def blockers(authority: Column, identity: Column, state: Column) -> Column:
    """Names of the gates a candidate doesn't pass, in order."""
    names = F.array(
        F.when(F.coalesce(authority, F.lit("")) != "confirmada", "authority"),
        F.when(F.coalesce(identity, F.lit("")) != "confirmada", "identity"),
        F.when(~F.coalesce(state, F.lit("")).isin("completa", "renderizada"), "evidence_state"),
    )
    return F.filter(names, lambda x: x.isNotNull())
