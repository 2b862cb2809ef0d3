import re

import pyarrow as pa
import pytest

from sondar.operators.packed import explode_packed, split_addresses

CASES = [
    (None, []),
    ("", []),
    ("  ", []),
    (";", []),
    ("[]", []),
    ("no_existe", []),
    ("NO EXISTE ", []),
    ("https://a.b.example/x", ["https://a.b.example/x"]),
    ("https://a.example/x;http://a.example/y", ["https://a.example/x", "http://a.example/y"]),
    ("https://a.example/x;jsessionid=AB12;www.c.example/z,", ["https://a.example/x;jsessionid=AB12", "www.c.example/z"]),
    ("https://a.example/?ids=29,69, https://a.example/?f=a|b|1", ["https://a.example/?ids=29,69", "https://a.example/?f=a|b|1"]),
    ('"https://a.example/?q=""uno""&p=1","https://a.example/y"', ['https://a.example/?q="uno"&p=1', "https://a.example/y"]),
    ('["https://a.example/1", "b.gov.example/2"]', ["https://a.example/1", "b.gov.example/2"]),
    ("“https://a.example/1”; «b.example/2»", ["https://a.example/1", "b.example/2"]),
    ("1) https://a.example/1 2) https://a.example/2", ["https://a.example/1", "https://a.example/2"]),
    ("1º http://a.example/1\n2º http://a.example/2", ["http://a.example/1", "http://a.example/2"]),
    ("- https://a.example/1 - www.a.example/2", ["https://a.example/1", "www.a.example/2"]),
    ("https://a.example/1 e https://a.example/1 y https://b.example/", ["https://a.example/1", "https://a.example/1", "https://b.example/"]),
    ("203.0.113.9:7081/x?a=1, https://203.0.113.9:7081/y", ["203.0.113.9:7081/x?a=1", "https://203.0.113.9:7081/y"]),
    ("<https://a.example/1>\r\n(https://a.example/2)", ["https://a.example/1", "https://a.example/2"]),
    ("https://a.example/" + "x" * 50_000 + " | https://b.example", ["https://a.example/" + "x" * 50_000, "https://b.example"]),
]


@pytest.mark.parametrize("value,want", CASES)
def test_one_value(value, want):
    assert split_addresses(pa.array([value], pa.string()))[1].to_pylist() == want


def test_rows_do_not_touch_each_other():
    parents, urls = split_addresses(pa.array([v for v, _ in CASES], pa.string()))
    got = [[] for _ in CASES]
    for p, u in zip(parents.tolist(), urls.to_pylist()):
        got[p].append(u)
    assert got == [w for _, w in CASES]


def test_against_a_plain_splitter(spark, small):
    """On unquoted fields the plain rule is: cut before every scheme, strip what surrounds."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"{small}/golden_set_v1.parquet")
    for f in ("urls_concursos_extra", "urls_processos_extra"):
        for v in t.column(f).to_pylist():
            if not v or re.search(r"[\"'“«]|(?<![:/\w])(?:www\.|\w+\.\w)", v):
                continue
            plain = [re.split(r"\s", x)[0].rstrip(",;|]> ") for x in re.split(r"(?=https?://)", v) if "://" in x]
            assert split_addresses(pa.array([v]))[1].to_pylist() == plain


def test_frame(spark):
    df = spark.createDataFrame([(1, "https://a.example/1,https://a.example/2", None, "url"), (1, "https://a.example/1", "x", "pos"), (None, "", "www.b.example", None)], "golden_id long, a string, b string, field_name string")
    got = sorted((r.golden_id or 0, r.field_name, r.pos, r.url) for r in explode_packed(df, "golden_id", ["a", "b"]).collect())
    assert got == [(0, "b", 1, "www.b.example"), (1, "a", 1, "https://a.example/1"), (1, "a", 1, "https://a.example/1"), (1, "a", 2, "https://a.example/2")]
    assert explode_packed(df.limit(0), "golden_id", ["a", "b"]).count() == 0
