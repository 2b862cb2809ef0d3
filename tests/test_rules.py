"""Rules against plain versions and literal cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sondar.functions import numbers as N
from sondar.functions import pages as P
from sondar.functions import text as T
from sondar.functions import urls as U
from sondar.operators import decisions as D
from sondar.operators import lines as L
from sondar.streaming import quota as Q


def column(spark, values, *exprs, name="x"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_keys_of_addresses(spark):
    cases = {
        "https://www.example.invalid/concursos/?b=2&a=1#top": "example.invalid/concursos?a=1&b=2",
        "no_existe": "", "NO_EXISTE ": "", "": "", None: "",
        "x.example/A/": "x.example/A", "http://X.example/a?B=1&a=%C3%A7&c=": "x.example/a?b=1&a=ç&c=", "http://x.example?q=a+b": "x.example?q=a b",
    }
    got = column(spark, list(cases), U.metric_key(F.col("x")))
    assert [g[0] for g in got] == list(cases.values())


def test_pages_reached_by_addresses(spark):
    rows = [("http://www.x.example/a/?ano=0", "https://x.example/a", True), ("http://x.example/a?ano=2020", "x.example/a", False), ("x.example", "http://x.example/", True), ("x.example/a?c=1", "x.example/a?c=2", False)]
    df = spark.createDataFrame(rows, "a string, b string, w boolean")
    assert all(r[0] == r[1] for r in df.select(U.same_page(F.col("a"), F.col("b")), "w").collect())


def test_addresses_by_kind(spark):
    hard = ["http://x/concurso/id/20/", "http://x/a/detalhe/4", "http://x/?slug=pss", "http://x/e.PDF?v=1"]
    other = ["http://x/conteudo/13/lista", "http://x/concursos", None, ""]
    assert [g[0] for g in column(spark, hard + other, U.hard_detail(F.col("x")))] == [True] * 4 + [False] * 4
    assert [g[0] for g in column(spark, other, U.maybe_detail(F.col("x")))] == [True, False, False, False]
    view = "http://v.example/view?file=http%3A%2F%2Fx.example%2Fe.pdf"
    assert column(spark, [view, "http://x.example/a"], U.unwrapped(F.col("x"))) == [("http://x.example/e.pdf",), ("http://x.example/a",)]
    assert [g[0] for g in column(spark, ["http://x/index.php", "http://x/site/", "x", "http://x/concursos", "http://x/a.xlsx"], P.landing(F.col("x")))] == [True, True, True, False, False]
    assert [g[0] for g in column(spark, ["http://x/a.xlsx", "http://x/a.zip", "http://x/a.DOC?x=1"], P.file_url(F.col("x")))] == [True, False, True]
    assert column(spark, ["http://203.0.113.7:80/a", "http://www.x.example/a"], U.freeze_group(F.col("x"))) == [("ipv4:203.0.113.0/24",), ("host:www.x.example",)]
    assert [g[0] for g in column(spark, ["https://m.facebook.com/x", "http://ibá.rs.gov.example"], U.listed_host(F.col("x")))] == [True, False]


@pytest.mark.parametrize("provider, good, bad", [
    ("legalle", "https://a/edital/ver/12", "https://a/edital/ver/x"), ("fundatec", "https://www.fundatec.org.br/home/?concurso=77", "https://www.fundatec.org.br/home/"),
    ("lasalle", "https://www.fundacaolasalle.org.br/concurso/x-1/", "https://fundacaolasalle.org.br/concurso/x/y"), ("selecao", "https://ibam.selecao.net.br/informacoes/9/", "https://selecao.net.br/x"),
    ("quadrix", "https://site.quadrix.org.br/informacoes/55/", "https://quadrix.org.br/"), ("objetiva", "https://concursos.objetivas.com.br/informacoes/3", "https://objetivas.com.br/informacoes/3"),
    ("cebraspe", "https://www.cebraspe.org.br/concursos/ABC_24", "https://www.cebraspe.org.br/concursos/"), ("consulplan", "https://www.institutoconsulplan.org.br/Concurso/abc", "https://www.institutoconsulplan.org.br/Concurso/abc/def"),
    ("fgv", "https://conhecimento.fgv.br/concursos/abc24", "https://conhecimento.fgv.br/concursos/nosso-portfolio"), ("cesgranrio", "https://www.cesgranrio.org.br/concurso/abc/", "https://www.cesgranrio.org.br/abc/"),
    ("faurgs", "https://portalfaurgs.com.br/concursosFaurgs/emandamento/abc", "https://portalfaurgs.com.br/concursosFaurgs/abc"), ("fcc", "https://www.concursosfcc.com.br/concursos/abc24/index.html", "https://www.concursosfcc.com.br/concursos/abc24/"),
    ("aocp", "https://www.institutoaocp.org.br/concursos/123", "https://www.institutoaocp.org.br/concursos/abc"), ("ibfc", "https://concursos.ibfc.org.br/informacoes/12/", "https://concursos.ibfc.org.br/12/"),
])
def test_links_of_providers(spark, provider, good, bad):
    got = column(spark, [good, bad, None], U.provider_detail(F.col("x"), provider), U.provider_of(F.col("x")))
    assert [g[0] for g in got] == [True, False, False] and got[0][1] == provider and got[2][1] == ""


def test_numbers_against_plain_patterns(spark):
    """The library's patterns on random texts, against the same rules run by another engine."""
    r = random.Random(3)
    bits = ["edital", "Edital ", "nº ", "n. ", "concurso ", "PSS ", "12", "3", "045", "2024", "24", "/", "-", ".", " ", " / ", "de abertura ", "Lei 13.019/2014 ", "12/05/2024", "\n", "processo seletivo "]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 9))) for _ in range(1500)]
    year = lambda y: int(y) if len(y) == 4 else int("20" + y)
    form = lambda a, b: f"nº {int(a):02d}/{year(b)}" if int(a) or True else None

    def label(t):
        m = re.search(r"(\d{1,4})\s*[/.-]\s*((?:20)?\d{2})(?!\d)(?!\s*[/.-]\s*\d)", t)
        return form(*m.groups()) if m else None

    def key(t):
        m = re.search(r"(?<![\d./])(\d{1,4})\s*[/\-]\s*(20[12]\d)\b", t)
        if m:
            return int(m[1]), int(m[2])
        m = re.search(r"(?:edital|concursos?|processos?\s+seletiv\w*|sele[cç][aã]o|\bpss\b|\bn(?:[º°]|o)?\b)\D{0,24}?(?<![\d./])(\d{1,4})\s*[/\-]\s*(\d{2})\b(?!\s*[/\-]\s*\d{2,4}\b)", t, re.I)
        return (int(m[1]), int(m[2]) + (2000 if int(m[2]) <= 39 else 1900)) if m else (None, None)

    got = column(spark, texts, N.number_label(F.col("x")), N.number_key(F.col("x")))
    assert [g[0] for g in got] == [label(t) for t in texts]
    assert [tuple(g[1]) for g in got] == [key(t) for t in texts]


def test_numbers_by_each_rule(spark):
    m = T.match_form(F.col("x"))
    got = column(spark, ["Edital de Abertura nº 3/24", "Concurso Público nº 007/2021 - Edital", "Lei 13.019/2014", None], N.named_label(F.col("x")), N.parts_label(m), N.titled_label(m), N.context_label(m), N.own_key(F.col("x")))
    assert got[0][:4] == ("nº 03/2024", "nº 03/2024", "nº 03/2024", "nº 03/2024") and got[0][4] is None
    assert got[1][:4] == ("nº 07/2021", "nº 07/2021", "nº 07/2021", "nº 07/2021")
    assert got[2][0] is None and got[3][:3] == (None, "", "")
    assert column(spark, ["PORTARIA Nº 012/2023\nnada"], N.own_key(F.col("x")))[0][0] == (12, 2023)
    assert column(spark, ["edital nº 1/2020 e edital nº 2/2021"], N.context_label(m, F.lit(2021)))[0][0] == "nº 02/2021"


def test_verdicts_on_truth(spark):
    rows = [("http://a.b/x", "", "", "MISS"), ("http://a.b/x", "", "https://www.a.b/x/", "HIT"), ("http://a.b/x", "http://c.d/y", "c.d/y", "HIT"), ("http://a.b/x", None, "a.b/z", "HOST"), ("http://a.b/x", None, "q.r", "WRNG"), ("no_existe", None, "", "T-NEG"), ("", "no_existe", "a.b", "F-POS"), (None, "", "a.b", "SKIP")]
    df = spark.createDataFrame(rows, "m string, e string, u string, w string")
    out = df.select(D.truth_verdict(F.col("m"), F.col("e"), F.col("u")).alias("v"), "w", D.truth_expectation(F.col("m"), F.col("e")).alias("x")).collect()
    assert [r.v for r in out] == [r.w for r in out]
    assert [r.x for r in out] == ["confirm"] * 5 + ["negative"] * 2 + ["golden_na"]


def test_flips_and_states(spark):
    kinds = {"confirm": "indice_oficial", "review": "revisar", "negative": "nao_encontrado"}
    want = {("review", "confirm"): "v2_confirm_v1_review", ("confirm", "review"): "v1_confirm_v2_review", ("review", "review"): "both_review", ("negative", "negative"): "both_negative", ("negative", "confirm"): "v2_confirm_v1_negative", ("confirm", "negative"): "v1_confirm_v2_negative", ("negative", "review"): "v2_review_v1_negative", ("review", "negative"): "v1_review_v2_negative"}
    df = spark.createDataFrame([(kinds[a], kinds[b], w) for (a, b), w in want.items()] + [("nueva", "revisar", None)], "a string, b string, w string")
    assert all(r[0] == r[1] for r in df.select(D.flip_class(F.col("a"), F.lit("x.y"), F.col("b"), F.lit("x.y")), "w").collect())
    two = df.limit(1).select(D.flip_class(F.lit("indice_oficial"), F.lit("http://x.y/"), F.lit("portal_externo_oficial"), F.lit("x.y")).alias("s"), D.flip_class(F.lit("indice_oficial"), F.lit("x.y"), F.lit("indice_oficial"), F.lit("x.z")).alias("t")).first()
    assert two.s == "both_confirm_same_resource" and two.t == "both_confirm_distinct_resource"
    states = [("boa", "nao_encontrada", "misto"), ("boa", "revisar", "revisar"), ("", None, "sem_saida_previa"), ("boa", "", "confirmado"), ("boa", "boa", "confirmado"), ("rara", "", None)]
    df = spark.createDataFrame(states, "a string, b string, w string")
    assert all(r[0] == r[1] for r in df.select(D.prior_state(F.col("a"), F.col("b")), "w").collect())
    pairs = [("CONF", "CONF", "green"), ("CONF", "PEND", "amber"), ("CONF", "VAC_RAW", "closed"), ("VAC_VERIF", "VAC_RAW", "red")]
    df = spark.createDataFrame(pairs, "a string, b string, w string")
    assert all(r[0] == r[1] for r in df.select(D.municipality_state(F.col("a"), F.col("b")), "w").collect())


def test_derived_decisions(spark):
    base = dict(source="banca", authority="confirmada", identity="confirmada", role="indice_listado", bucket="concurso_publico", evidence="completa", accessible=True, procurement=False, cultural=False)
    cases = [({}, "indice_oficial"), ({"accessible": False}, "revisar"), ({"evidence": "otra"}, "revisar"), ({"procurement": True, "cultural": True}, "licitacao_rechazada"), ({"cultural": True}, "concurso_cultural_rechazado"), ({"evidence": "incompleta_antibot", "role": "noticia"}, "revisar"), ({"role": "detalle_individual", "identity": None}, "detalle_individual_rechazado"), ({"role": "noticia"}, "nao_encontrado"), ({"role": "menu_sin_listado"}, "revisar"), ({"role": None}, "nao_encontrado"), ({"identity": "rechazada"}, "revisar"), ({"authority": ""}, "revisar"), ({"source": "portal_externo_delegado"}, "portal_externo_oficial"), ({"source": "portal_externo_delegado", "authority": "rechazada"}, "revisar"), ({"role": "indice_combinado"}, "indice_oficial_combinado"), ({"bucket": "otro"}, "indice_oficial_combinado")]
    names = list(base)
    rows = [tuple({**base, **c}.values()) + (w,) for c, w in cases]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'boolean' if isinstance(base[n], bool) else 'string'}" for n in names) + ", w string")
    assert all(r[0] == r[1] for r in df.select(D.derived_decision(*[F.col(n) for n in names]), "w").collect())


def test_picks_hide_combined_records_and_report_ties(spark):
    rows = [("a", "c", "1", "c", "indice_oficial"), ("a", "c", "2", "combinado", "indice_oficial"), ("b", "c", "1", "combinado", "indice_oficial"), ("b", "c", "1", "combinado", "indice_oficial"), ("d", "c", "1", "c", "indice_oficial"), ("d", "c", "2", "c", "portal_externo_oficial"), ("e", "c", "1", "c", "revisar"), ("f", "c", "1", "p", "indice_oficial")]
    df = spark.createDataFrame(rows, "m string, b string, id string, rb string, dec string")
    got = {r.m: (r.id, r.outcome) for r in D.resolved_picks(df, ["m", "b"], "b", "id", "rb", "dec").collect()}
    assert got == {"a": ("1", "selected"), "b": ("1", "selected_duplicate"), "d": (None, "tie"), "e": (None, "none_eligible"), "f": (None, "none_eligible")}
    assert D.resolved_picks(df.limit(0), ["m", "b"], "b", "id", "rb", "dec").count() == 0


def test_gate(spark):
    b = D.gate_blockers(F.lit("rechazada"), F.lit(None).cast("string"), F.lit(True), F.lit("completa"), F.lit("revisar"), F.lit("combinado"), F.lit("concurso_publico"))
    assert spark.range(1).select(b).first()[0] == ["authority=rechazada", "identity=", "decision=revisar"]


def test_lines_against_plain_loops(spark):
    r = random.Random(5)
    texts = ["\n".join(r.choice(["a1", "b", "cc", "", "d2"]) for _ in range(r.randint(0, 12))) for _ in range(60)] + ["", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", L.lines(F.col("t")).alias("ls"))
    df = df.withColumn("m", L.marked(F.col("ls"), lambda x: x.rlike("[0-9]"))).withColumn("at", L.starts(F.col("ls"), lambda x: x.rlike("[0-9]")))
    out = df.select("t", L.near_counts(F.col("m"), 2, 1).alias("n"), L.last_above(F.col("ls"), F.col("m"), 3).alias("u"), L.first_below(F.col("ls"), F.col("m"), 2).alias("d"), L.within(F.col("ls"), 1, 2).alias("w"), L.blocks(F.col("at"), F.size("ls")).alias("b")).collect()
    for row in out:
        ls = row.t.split("\n")
        hit = [bool(re.search(r"\d", x)) for x in ls]
        assert row.n == [sum(hit[max(0, i - 2) : i + 2]) for i in range(len(ls))]
        assert row.u == [next((ls[j] for j in range(i - 1, max(-1, i - 4), -1) if hit[j]), None) for i in range(len(ls))]
        assert row.d == [next((ls[j] for j in range(i + 1, min(len(ls), i + 3)) if hit[j]), None) for i in range(len(ls))]
        assert row.w == ["\n".join(ls[max(0, i - 1) : i + 3]) for i in range(len(ls))]
        at = [i for i, h in enumerate(hit) if h]
        assert [tuple(x) for x in row.b] == [(a + 1, (at[k + 1] if k + 1 < len(at) else len(ls)) - a) for k, a in enumerate(at)]
    assert df.limit(1).select(L.first_with(F.array(F.lit("a"), F.lit("bc")), F.lit("c"))).first()[0] == 2


def test_pages(spark):
    rows = [(429, "", "", ""), (200, "Just a moment...", "x", ""), (200, "t", "c", "<p>by Cloudflare</p>"), (200, "", "Use: aceite os cookies", ""), (None, "Página não encontrada", "", ""), (200, "", "Edital 01/2024", "")]
    df = spark.createDataFrame(rows, "s int, t string, c string, h string")
    got = df.select(P.blocked(F.col("s"), F.col("h")), P.guarded(F.lower("t"), F.col("c"), F.lower("h")), P.challenged(F.lower("t"), F.lower("c"), F.lower("h")), P.walled(F.col("c"), T.fold(F.col("c")), F.lit(0)), P.soft404(F.col("s"), P.title_and_head(F.col("t"), F.col("c"), 500)), P.has_entry(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(True, False, False, False, True, False), (False, True, True, False, False, False), (False, False, True, False, False, False), (False, False, False, True, False, False), (False, False, False, False, True, False), (False, False, False, False, False, True)]


def test_rolling_over_slices_is_rolling(spark, small):
    e = spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    cut = Q.rolling_rows(e, "event_type", "ts", 3600, {"n": F.lit(1)}, slice_s=7200).select("event_id", "n")
    whole = e.select("event_id", Q.rolling(e, "event_type", "ts", 3600).alias("n"))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_admission(spark):
    assert Q.admitted([(0, 10), (1, 10), (2, 10), (3, 10)], rpm=2, tpm=1000, rpd=100) == [(0, "admitted"), (1, "admitted"), (60, "admitted"), (61, "admitted")]
    assert Q.admitted([(0, 60), (1, 60), (2, 200)], rpm=9, tpm=100, rpd=100) == [(0, "admitted"), (60, "admitted"), (60, "too_large")]
    assert [s for _, s in Q.admitted([(0, 1), (1, 1), (86_400, 1)], rpm=9, tpm=9, rpd=1)] == ["admitted", "day_spent", "admitted"]
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("b", 0, 1)], "k string, t long, n int").withColumn("ts", F.timestamp_seconds("t"))
    got = sorted((r.k, r.t, r.admitted_at, r.state) for r in Q.admit(df, "k", "ts", "n", 1, 10, 10).collect())
    assert got == [("a", 0, 0.0, "admitted"), ("a", 1, 60.0, "admitted"), ("b", 0, 0.0, "admitted")]


def test_freezes_on_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    df = spark.createDataFrame([("g", 100), ("g", 200), ("h", 50)], "grp string, t long").select("grp", F.timestamp_seconds("t").alias("ts"))
    df.coalesce(1).write.parquet(str(src))
    out = Q.run_available(Q.stream_freezes(spark.readStream.schema(df.schema).parquet(str(src)), "ts", "grp"), "frz", str(tmp_path / "cp"), "update")
    assert sorted(map(tuple, out.collect())) == [("g", 2, 2900.0), ("h", 1, 950.0)]
    now = out.select("grp", Q.frozen(F.timestamp_seconds(F.lit(1000)), F.col("until_s")).alias("f"))
    assert sorted(map(tuple, now.collect())) == [("g", True), ("h", False)]
