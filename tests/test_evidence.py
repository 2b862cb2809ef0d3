"""Authority, citations and selection against plain versions."""

import random

from pyspark.sql import functions as F

from sondar.operators import citations as C
from sondar.operators import evidence as E

SUFFIX = ".rs.gov.example"


def test_official_hosts_and_redirects(spark):
    rows = [("http://www.ibá.rs.gov.example/a", "http://portal.example", "Ibá", False), ("http://www.iba.rs.gov.example/a", "http://portal.example", "Ibá", True), ("http://iba.rs.gov.example", "http://iba.rs.gov.example/x", "Ibá", False), ("http://iba.rs.gov.example", "https://m.facebook.com/x", "Ibá", False), ("http://iba.rs.gov.example", None, "Ibá", False), ("http://iba.rs.gov.example", "http://x.example", None, False)]
    df = spark.createDataFrame(rows, "r string, f string, m string, w boolean")
    out = df.select(F.coalesce(E.redirect_confirms(F.col("r"), F.col("f"), F.col("m"), SUFFIX), F.lit(False)).alias("g"), "w", F.size(E.redirect_provenance(F.col("r"), F.col("f"), F.col("m"), SUFFIX)).alias("n")).collect()
    assert all(x.g == x.w and x.n == int(x.w) for x in out)


def test_registry_match_is_by_municipality(spark):
    pages = spark.createDataFrame([(1, "Ibá", "http://sub.iba.example/x"), (2, "Outra", "http://iba.example"), (3, "IBA", "http://www.iba.example"), (4, None, "http://iba.example"), (5, "Ibá", None), (6, "Ibá", "http://xiba.example")], "k int, m string, u string")
    reg = spark.createDataFrame([("Ibá", "iba.example", "e1"), ("Ibá", "www.iba.example", "e2"), ("Outra", None, "e")], "municipio string, host string, evidencia string")
    got = {x.k: x.registered_host for x in E.registered(pages, reg, "k", "m", "u").collect()}
    assert got == {1: "iba.example", 3: "iba.example"}
    assert E.registered(pages.limit(0), reg, "k", "m", "u").count() == 0


def test_provenance_confirms(spark):
    p = F.array(F.create_map(F.lit("kind"), F.lit("official_brand"), F.lit("municipio"), F.lit("IBÁ")))
    row = spark.range(1).select(E.provenance_confirms(p, F.lit("ibá")).alias("a"), E.provenance_confirms(p, F.lit("x")).alias("b"), E.provenance_confirms(F.lit(None).cast("array<map<string,string>>"), F.lit("x")).alias("c")).first()
    assert tuple(row) == (True, False, False)


def test_identity_and_authority(spark):
    t, f = F.lit(True), F.lit(False)
    u, o, m = F.lit("http://iba.rs.gov.example"), F.lit("http://x.example"), F.lit("Ibá")
    s = E.identity_state
    got = spark.range(1).select(s(f, u, t, t, m, SUFFIX), s(t, u, f, f, F.lit("Outra"), SUFFIX), s(t, o, t, f, m, SUFFIX), s(t, o, f, t, m, SUFFIX), s(t, o, f, f, m, SUFFIX)).first()
    assert tuple(got) == ("rechazada", "rechazada", "confirmada", "confirmada", "desconocida")
    a = lambda url, brand, chain, ident, ext: E.source_and_authority(url, brand, chain, F.lit(ident), ext, SUFFIX)
    got = spark.range(1).select(a(u, t, f, "confirmada", f), a(u, f, t, "confirmada", f), a(o, t, t, "x", f), a(o, t, f, "x", t), a(o, t, f, "x", f)).first()
    assert [tuple(x) for x in got] == [("dominio_oficial_prefeitura", "confirmada"), ("dominio_oficial_prefeitura", "desconocida"), ("portal_externo_delegado", "confirmada"), ("portal_externo_delegado", "desconocida"), ("desconocido", "desconocida")]


def test_occurrences_against_plain_search(spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choice("ab.") for _ in range(r.randint(0, 30))), r.choice(["a", "ab", "a.", "aa", "", "zz"])) for i in range(400)]
    out = spark.createDataFrame(rows, "i int, t string, q string").select("i", "t", "q", E.find_all(F.col("t"), F.col("q"), 3).alias("f"), C.occurrences(F.col("t"), F.col("q")).alias("n")).collect()
    for x in out:
        at, found = 0, []
        while x.q and (at := x.t.find(x.q, at)) >= 0:
            found.append(at)
            at += len(x.q)
        assert list(x.f.offsets) == found[:3] and x.f.has_more == (len(found) > 3) and x.n == len(found)


def test_citations(spark):
    t = F.lit("abc def abc")
    v = C.verified
    got = spark.range(1).select(v(t, F.lit(4), F.lit(7), F.lit("def")), v(t, F.lit(0), F.lit(3), F.lit("def")), v(t, F.lit(0), F.lit(3), F.lit("xyz")), v(t, F.lit(9), F.lit(12), F.lit("c")), v(F.lit(""), F.lit(0), F.lit(1), F.lit("a"))).first()
    assert tuple(got) == (None, "offset_quote_mismatch", "quote_not_found", "offset_out_of_bounds", "empty_source")


def test_consensus(spark):
    L = F.lit
    none = L(None).cast("string")

    def code(d1, agreed, d2="revisar", pros=None, gate=True, b1="concurso_publico"):
        return E.consensus_code(L("concurso_publico"), L(d1), L(b1), L(agreed), L(d2), none if pros is None else L(pros), L(gate))

    cases = [(code("indice_oficial", True, b1="processo_seletivo"), "bucket_mismatch"), (code("revisar", True), "agreement_review"), (code("nao_encontrado", True), "proposal_a_not_affirmative"), (code("indice_oficial", True, pros="otro"), "prosecutor_invalid"), (code("indice_oficial", True, pros="review"), "prosecutor_review"), (code("indice_oficial", False, pros="sustain"), "prosecutor_invalid"), (code("indice_oficial", False, d2="indice_oficial", pros="block"), "prosecutor_invalid"), (code("indice_oficial", True), "consensus"), (code("indice_oficial", True, gate=False), "consensus_failed_final_gate"), (code("indice_oficial", False, pros="block"), "judge"), (code("indice_oficial", False), "judge")]
    assert list(spark.range(1).select(*[c for c, _ in cases]).first()) == [w for _, w in cases]
    o = spark.range(1).select(E.prosecutor_result(F.array(L("proved"), L("unresolved"))), E.prosecutor_result(F.array(L("unresolved"))), E.prosecutor_result(F.array(L("cleared")))).first()
    assert tuple(o) == ("block", "review", "sustain")
    assert spark.range(1).select(E.missing_dimensions(F.array(L("bucket")), ("identity", "bucket", "authority"))).first()[0] == ["authority", "identity"]


def test_sample_takes_turns_and_keeps_the_reserve(spark):
    rows = [(f"m{i}", "big" if i % 10 else "small", f"s{i % 3}", i % 4 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "m string, f string, s string, b boolean")
    got = E.select_sample(df, "m", "f", "s", F.col("b"), 30, 8, "x").collect()
    assert len(got) == 30 == len({x.m for x in got})
    assert sum(x.phase == "borderline_reserve" for x in got) == 8
    fill = [x for x in got if x.phase == "family_fill"]
    assert abs(sum(x.f == "big" for x in fill) - sum(x.f == "small" for x in fill)) <= 6
    assert E.select_sample(df.limit(5), "m", "f", "s", F.col("b"), 30, 8, "x").count() == 5
    assert E.select_sample(df.limit(0), "m", "f", "s", F.col("b"), 30, 8, "x").count() == 0


def test_paging(spark):
    got = spark.range(1).select(E.paged(F.lit("abcdef"), 2, 3).alias("a"), E.paged(F.lit("abcde"), 2, 3).alias("b")).first()
    assert tuple(got.a) == ("cde", 5, True) and tuple(got.b) == ("cde", None, False)
