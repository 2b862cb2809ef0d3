"""Loose JSON, redaction, differences and mentions."""

import random

import pytest
from pyspark.sql import functions as F

from sondar.functions import records as X
from sondar.operators import relational as R


def values(spark, xs, expr):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
    return [r.v for r in df.select("i", expr(F.col("x")).alias("v")).orderBy("i").collect()]


def test_loose_json(spark):
    got = values(spark, ['```json\n{"a": 1}\n```', 'Here: {"a": 2} ok', '[{"a": 3}]', '{"a": ', "", None, "no"], lambda c: X.loose_object(c, "a int"))
    assert [g.a if g else None for g in got] == [1, 2, 3, None, None, None, None]
    cut = values(spark, ['[{"q":"x","e":"y"},{"q":"z","e":null},{"q":"w","e":"v"},{"q":"b', None], lambda c: X.salvaged(c, "q string, e string", ("q", "e")))
    assert [tuple(x) for x in cut[0]] == [("x", "y"), ("w", "v")] and cut[1] is None


def test_redaction(spark):
    m = F.create_map(F.lit("Token"), F.lit("abc"), F.lit("note"), F.lit("Bearer abcdefgh12 x"))
    row = spark.range(1).select(X.redacted_map(m).alias("m"), X.sorted_pairs(m).alias("p")).first()
    assert row.m == {"Token": "***", "note": "Bearer *** x"} and [x.key for x in row.p] == ["Token", "note"]
    assert values(spark, ["Authorization: bearer abcdefghij", "bearer x", None], X.has_secret) == [True, False, False]


def test_differences(spark):
    df = spark.createDataFrame([("a", None, "a", ""), ("x" * 100, "k", "y", "l"), (None, "k", None, "k")], "a string, b string, c string, e string")
    one, two = {"f": F.col("a"), "g": F.col("b")}, {"f": F.col("c"), "g": F.col("e")}
    got = df.select(X.field_diffs(one, two).alias("d"), X.changed_names(one, two).alias("n")).collect()
    assert [g.d for g in got] == [[], [f"f: '{'x' * 90}' -> 'y'", "g: 'k' -> 'l'"], []]
    assert [g.n for g in got] == ["g", "f,g", ""]


def test_bounds(spark):
    assert values(spark, ["ok", None], lambda c: X.bounded(c, "f", 5)) == ["ok", None]
    for bad in ("too long", "a\x01"):
        with pytest.raises(Exception, match="control characters"):
            values(spark, [bad], lambda c: X.bounded(c, "f", 5))
    assert values(spark, ["", "x" * 9], X.tokens_estimate) == [1, 2]
    df = spark.createDataFrame([(" v ",)], "b string")
    assert df.select(X.first_column(df.columns, "a", "b").alias("x"), X.first_column(df.columns, "z").alias("y")).first() == ("v", "")


def test_mentions_against_plain_search(spark):
    r = random.Random(4)
    names = ["a", "a b", "b c a", "c", "c c"]
    texts = [(i, " ".join(r.choice("abcd") for _ in range(r.randint(0, 9)))) for i in range(200)] + [(900, None)]
    df, n = spark.createDataFrame(texts, "k int, t string"), spark.createDataFrame([(x,) for x in names + [None, ""]], "n string")
    got = {x.k: x.n for x in R.longest_mention(df, "k", "t", n, "n").collect()}
    want = {}
    for k, t in texts:
        hit = [x for x in names if f" {x} " in f" {t} "] if t else []
        if hit:
            want[k] = min(hit, key=lambda x: (-len(x), x))
    assert got == want
    assert R.mentions(df.limit(0), "k", "t", n, "n").count() == 0 and R.mentions(df, "k", "t", n.limit(0), "n").count() == 0
