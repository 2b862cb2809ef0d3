"""Sources and sinks with checks."""

import json

import pytest
from pyspark.sql import functions as F

from sondar.sources import documents as S
from sondar.streaming import quota as Q


def test_json_folder(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.json").write_text(json.dumps({"url": "u", "anchors": [{"href": "h", "text": "t"}], "more": 1}, indent=1))
    (d / "b.json").write_text(json.dumps({"url": "v"}))
    df = S.read_json_folder(spark, str(d), "url string, anchors array<struct<href:string,text:string>>")
    got = {r.url: (r.source.rsplit("/", 1)[1], r.anchors and r.anchors[0].href) for r in df.collect()}
    assert got == {"u": ("a.json", "h"), "v": ("b.json", None)}
    (d / "c.json").write_text('{"url": ')
    with pytest.raises(Exception):
        S.read_json_folder(spark, str(d), "url string").collect()


def test_strict_tables(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    assert S.strict_columns(df, ["k", "v"]) is df
    with pytest.raises(ValueError, match="missing \\['z'\\]"):
        S.strict_columns(df, ["k", "z"])
    assert sorted(map(tuple, S.unique(df, ["k"]).collect())) == [("a", "1"), ("b", "2")]
    with pytest.raises(Exception, match="repeated key: a"):
        S.unique(df.union(df.limit(1)), ["k"]).collect()
    assert S.unique(df.limit(0), ["k"]).count() == 0
    with pytest.raises(Exception, match="v is required"):
        S.required(spark.createDataFrame([("a", " ")], "k string, v string"), ["k", "v"]).collect()


def test_patterns(spark, tmp_path):
    (tmp_path / "p.txt").write_text("# hosts\n*.x.example  # all\n\nportal-?.example\n")
    ps = S.read_patterns(spark, str(tmp_path / "p.txt"))
    hosts = spark.createDataFrame([("a.X.example",), ("x.example",), ("portal-1.example",), ("portal-12.example",), ("axxexample",)], "h string")
    got = hosts.join(ps, S.matches_pattern(F.col("h"), F.col("pattern"))).select("h").distinct().collect()
    assert sorted(r.h for r in got) == ["a.X.example", "portal-1.example"]


def test_decoding(spark):
    rows = [("ação".encode(), "utf-8"), ("ação".encode("latin-1"), "utf-8"), ("ação".encode("latin-1"), "ISO-8859-1"), ("ação".encode(), "latin-1"), (b"\xef\xbb\xbfa", None), (b"abc", ""), (None, "utf-8"), (b"", None)]
    df = spark.createDataFrame([(i, b, c) for i, (b, c) in enumerate(rows)], "i int, b binary, c string")
    got = [(r.d.text, list(r.d.diagnostics)) for r in df.select("i", S.decoded(F.col("b"), F.col("c")).alias("d")).orderBy("i").collect()]
    assert got == [("ação", ["valid:utf-8"]), ("ação", ["fallback:iso-8859-1", "declared_charset_invalid"]), ("ação", ["declared:iso-8859-1"]), ("ação".encode().decode("latin-1"), ["declared:iso-8859-1", "valid_utf8_despite_declared"]), ("a", ["bom:utf-8"]), ("abc", ["valid:utf-8"]), (None, []), ("", ["valid:utf-8"])]


def test_flattening(spark):
    df = spark.createDataFrame([(1, {"x": 1}, ["a", None, "b"])], "k int, m map<string,int>, l array<string>").select("k", F.struct(F.col("k").alias("b"), F.struct(F.lit("q").alias("c")).alias("d")).alias("a"), F.lit(5).alias("a_b"), "m", "l")
    out = S.flattened(df)
    assert out.columns == ["k", "a_b", "a_d_c", "a_b_2", "m", "l"] and tuple(out.first()) == (1, 1, "q", 5, '{"x":1}', "a | b")


def test_publication_is_all_or_nothing(spark, tmp_path):
    p = str(tmp_path / "t")
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    S.publish(ok, spark, p, {"positive": F.col("k") > 0})
    with pytest.raises(ValueError, match="positive"):
        S.publish(ok.union(spark.createDataFrame([(None,), (-1,)], "k int")), spark, p, {"positive": F.col("k") > 0})
    assert sorted(r.k for r in spark.read.parquet(p).collect()) == [1, 2] and [x.name for x in tmp_path.iterdir()] == ["t"]
    S.publish(ok.limit(0), spark, p, {"positive": F.col("k") > 0})
    assert spark.read.parquet(p).count() == 0


def test_refusing_limiter():
    assert [s for _, s in Q.admitted([(0, 1), (1, 1), (59.9, 1), (60, 1)], 2, 10, 100, wait=False)] == ["admitted", "admitted", "refused", "admitted"]
