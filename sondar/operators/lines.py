"""Positional operators over the lines of a text, as array functions: no row is exploded to be brought together again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def lines(text: Column) -> Column:
    """The lines of a text, empty ones too; null for null."""
    return F.split(text, "\n", -1)


def marked(ls: Column, cond: Callable[[Column], Column]) -> Column:
    """1 for each line that meets a condition, else 0."""
    return F.transform(ls, lambda x: F.coalesce(cond(x).cast("int"), F.lit(0)))


def near_counts(marks: Column, before: int, after: int) -> Column:
    """For each line, how many marked ones lie within the distances, itself among them. marks is a column by itself."""

    def count(_, i: Column) -> Column:
        out = F.lit(0)
        for k in range(-before, after + 1):
            out = out + F.coalesce(F.get(marks, i + k), F.lit(0))
        return out

    return F.transform(marks, count)


def last_above(ls: Column, marks: Column, reach: int) -> Column:
    """For each line, the nearest marked line above, within reach; null if there is none. Both are columns by themselves."""
    return F.transform(ls, lambda _, i: F.coalesce(*[F.when(F.get(marks, i - k) == 1, F.get(ls, i - k)) for k in range(1, reach + 1)]))


def first_below(ls: Column, marks: Column, reach: int) -> Column:
    """For each line, the nearest marked line below, within reach; null if there is none. Both are columns by themselves."""
    return F.transform(ls, lambda _, i: F.coalesce(*[F.when(F.get(marks, i + k) == 1, F.get(ls, i + k)) for k in range(1, reach + 1)]))


def within(ls: Column, before: int, after: int) -> Column:
    """For each line, the text of the lines within the distances, itself among them, joined by line feeds."""
    n = F.size(ls)

    def joined(i: Column) -> Column:
        a = F.greatest(F.lit(1), i - before)
        return F.array_join(F.slice(ls, a, F.least(n, i + after) - a + 1), "\n")

    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), joined))


def starts(ls: Column, cond: Callable[[Column], Column]) -> Column:
    """Numbers of the lines, from 1, that meet a condition."""
    at = F.transform(ls, lambda x, i: F.when(cond(x), i + 1))
    return F.array_compact(at)


def blocks(starts: Column, n: Column) -> Column:
    """(first_line, line_count) of the blocks of n lines that begin at `starts`, a column by itself, and end before the next one."""
    return F.transform(starts, lambda s, k: F.struct(s.alias("first_line"), (F.coalesce(F.try_element_at(starts, k + 2), n + 1) - s).alias("line_count")))


def first_with(ls: Column, quote: Column) -> Column:
    """Number of the first line, from 1, that holds a quote; null if none does or the quote is empty."""
    at = F.array_position(F.transform(ls, lambda x: F.contains(x, quote)), F.lit(True))
    return F.when((F.length(quote) > 0) & (at > 0), at.cast("int"))
