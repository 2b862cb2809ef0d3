"""Queries of authority, identity, citations, consensus and selection, each with its DuckDB equivalent where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondar.functions import pages as P
from sondar.functions import records as X
from sondar.functions import text as T
from sondar.functions import urls as U
from sondar.operators import citations as C
from sondar.operators import decisions as D
from sondar.operators import evidence as E
from sondar.operators import relational as R
from sondar.plans.tables import table
from sondar.queries.engine import _S_MUNI, _S_PARKED, _S_SOFT, _s_th, s_any, s_bare, s_fold, s_host, s_metric

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SUFFIX = ".gov.example"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_S_OKAY = "(status IS NULL OR status BETWEEN 200 AND 399)"
_S_SLUG = f"array_to_string(list_filter(string_split({s_fold('municipio')}, ' '), lambda w: w NOT IN ('da', 'de', 'do', 'das', 'dos')), '')"
_S_NEVER = ("facebook.", "instagram.", "youtube.", "twitter.", "x.com", "linkedin.", "acheconcursos.", "pciconcursos.", "qconcursos.", "google.", "bing.", "duckduckgo.")


def _s_official(u: str) -> str:
    return f"(ends_with({s_host(u)}, '.gov.example') AND list_contains(string_split(left({s_host(u)}, length({s_host(u)}) - 12), '.'), {_S_SLUG}))"


_S_REDIRECT = f"coalesce({s_host('requested_url')} <> '' AND {s_host('final_url')} <> '' AND {s_host('requested_url')} <> {s_host('final_url')} AND NOT {s_any(s_host('final_url'), _S_NEVER)} AND {_s_official('requested_url')}, false)"


@query(f"SELECT evidence_id, coalesce({_s_official('final_url')}, false) AS official, {_S_REDIRECT} AS redirect_confirms, CASE WHEN {_S_REDIRECT} THEN {s_host('requested_url')} || ' -> ' || {s_host('final_url')} END AS evidence FROM fetched_evidence")
def redirect_authority(spark: SparkSession, d: str) -> DataFrame:
    """Whether a page lies on an official host, and whether a redirect from one confirms it."""
    m, r, f = F.col("municipio"), F.col("requested_url"), F.col("final_url")
    x = table(spark, d, "fetched_evidence").select("evidence_id", E.official_host(f, m, SUFFIX).alias("official"), F.coalesce(E.redirect_confirms(r, f, m, SUFFIX), F.lit(False)).alias("redirect_confirms"), E.redirect_provenance(r, f, m, SUFFIX).alias("p"))
    return x.select("evidence_id", "official", "redirect_confirms", F.try_element_at("p", F.lit(1))["evidence"].alias("evidence"))


_S_REG = f"""SELECT e.evidence_id, min(row(r.h, r.e)) AS x FROM (SELECT evidence_id, {s_fold('municipio')} AS m, {s_bare('final_url')} AS h FROM fetched_evidence) e
    JOIN (SELECT {s_fold('municipio')} AS m, {s_bare('host')} AS h, coalesce(evidencia, '') AS e FROM dominios_oficiales) r ON e.m = r.m AND (e.h = r.h OR ends_with(e.h, '.' || r.h)) WHERE e.m <> '' AND e.h <> '' AND r.h <> '' GROUP BY e.evidence_id"""


@query(f"SELECT evidence_id, x[1] AS registered_host, x[2] AS evidence FROM ({_S_REG})")
def registered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages on a registered host of their municipality, or below one."""
    return E.registered(table(spark, d, "fetched_evidence"), table(spark, d, "dominios_oficiales"), "evidence_id", "municipio", "final_url")


_S_NAMED = f"coalesce({s_fold('municipio')} <> '' AND contains({_s_th(3000)}, {s_fold('municipio')}), false)"
_S_IDENT = f"""SELECT f.evidence_id, CASE WHEN NOT ({_S_OKAY} AND NOT {s_any(_s_th(500), _S_SOFT)} AND NOT {s_any(_s_th(800), _S_PARKED)}) OR coalesce(ends_with({s_host('final_url')}, '.gov.example') AND NOT coalesce({_s_official('final_url')}, false), false) THEN 'rechazada'
    WHEN {_S_NAMED} OR g.evidence_id IS NOT NULL THEN 'confirmada' ELSE 'desconocida' END AS identity, g.evidence_id IS NOT NULL AS chain, ends_with({s_host('final_url')}, '.gov.example') AS gov, regexp_matches({_s_th(3000)}, '\\b(prefeitura|municipio|portal oficial)\\b') AS branded
    FROM fetched_evidence f LEFT JOIN ({_S_REG}) g USING (evidence_id)"""


@query(f"""SELECT evidence_id, identity, CASE WHEN NOT gov AND chain THEN 'portal_externo_delegado' WHEN gov THEN 'dominio_oficial_prefeitura' ELSE 'desconocido' END AS source_kind,
    CASE WHEN CASE WHEN gov THEN identity = 'confirmada' AND branded ELSE chain END THEN 'confirmada' ELSE 'desconocida' END AS authority FROM ({_S_IDENT})""")
def identity_states(spark: SparkSession, d: str) -> DataFrame:
    """Identity, kind of source and authority of each page; the registry is the chain that can confirm them."""
    f = table(spark, d, "fetched_evidence")
    t, c, u, m = F.col("title"), F.col("content"), F.col("final_url"), F.col("municipio")
    heads = {n: P.title_and_head(t, c, n) for n in (500, 800, 3000)}
    x = f.select("evidence_id", "status", u, m, T.fold(m).alias("name"), *[h.alias(f"h{n}") for n, h in heads.items()])
    x = x.join(registered_pages(spark, d).select("evidence_id", F.lit(True).alias("chain")), "evidence_id", "left").withColumn("chain", F.coalesce("chain", F.lit(False)))
    usable = ~P.soft404(F.col("status"), F.col("h500")) & ~T.contains_any(F.col("h800"), P.PARKED)
    named = F.coalesce((F.col("name") != "") & F.contains(F.col("h3000"), F.col("name")), F.lit(False))
    x = x.withColumn("identity", E.identity_state(usable, u, named, F.col("chain"), m, SUFFIX))
    sa = E.source_and_authority(u, F.col("h3000").rlike(r"\b(?:prefeitura|municipio|portal oficial)\b"), F.col("chain"), F.col("identity"), F.lit(False), SUFFIX)
    return x.select("evidence_id", "identity", sa.alias("sa")).select("evidence_id", "identity", "sa.*")


@query("""SELECT evidence_id, CASE WHEN coalesce(content, '') = '' THEN 'empty_source' WHEN stop > length(content) THEN 'offset_out_of_bounds' WHEN substring(content, a + 1, stop - a) <> quote THEN CASE WHEN contains(content, quote) THEN 'offset_quote_mismatch' ELSE 'quote_not_found' END END AS failure
    FROM (SELECT evidence_id, content, title AS quote, 20 AS a, 20 + length(title) AS stop FROM fetched_evidence WHERE length(title) >= 8)""")
def citation_checks(spark: SparkSession, d: str) -> DataFrame:
    """Titles cited at a fixed place of the text, and why the citation fails; null where it holds."""
    q = table(spark, d, "fetched_evidence").where(F.length("title") >= 8)
    return q.select("evidence_id", C.verified(F.col("content"), F.lit(20), F.lit(20) + F.length("title"), F.col("title")).alias("failure"))


@query("""SELECT host, count(*) AS total, count(*) FILTER (failure IS NULL) AS verified, count(*) FILTER (failure IS NULL) = count(*) AS accepted FROM (
    SELECT host, CASE WHEN coalesce(content, '') = '' THEN 'empty_source' WHEN NOT contains(content, title) THEN 'quote_not_found' END AS failure FROM fetched_evidence WHERE length(title) >= 8 AND host IS NOT NULL) GROUP BY host""")
def citation_batches(spark: SparkSession, d: str) -> DataFrame:
    """A host's citations as one batch: any failure rejects it."""
    q = table(spark, d, "fetched_evidence").where((F.length("title") >= 8) & F.col("host").isNotNull())
    ok = (F.coalesce("content", F.lit("")) != "") & F.contains(F.coalesce("content", F.lit("")), F.col("title"))
    return q.groupBy("host").agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("verified"), F.bool_and(ok).alias("accepted"))


@query("SELECT doc_id, coalesce(length(text), 0) AS length, sha256(coalesce(text, '')) AS content_sha256, substring(text, 1001, 500) AS slice, CASE WHEN length(text) > 1500 THEN 1500 END AS next_start, coalesce(length(text) > 1500, false) AS has_more FROM documents")
def source_slices(spark: SparkSession, d: str) -> DataFrame:
    """Sources with length and hash, and a slice of 500 characters from the 1001st."""
    t = F.col("text")
    x = table(spark, d, "documents").select("doc_id", F.coalesce(F.length(t), F.lit(0)).alias("length"), F.sha2(F.coalesce(t, F.lit("")), 256).alias("content_sha256"), E.paged(t, 1000, 500).alias("p"))
    return x.select("doc_id", "length", "content_sha256", F.col("p.content").alias("slice"), "p.next_start", F.coalesce("p.has_more", F.lit(False)).alias("has_more"))


@query("""WITH RECURSIVE f(doc_id, txt, p, k) AS (SELECT doc_id, text, instr(text, 'edital'), 1 FROM documents WHERE contains(text, 'edital')
      UNION ALL SELECT doc_id, txt, p + 5 + instr(substring(txt, p + 6), 'edital'), k + 1 FROM f WHERE k < 21 AND contains(substring(txt, p + 6), 'edital'))
    SELECT doc_id, list((p - 1)::INT ORDER BY k) FILTER (k <= 20) AS offsets, max(k) > 20 AS has_more FROM f GROUP BY doc_id""")
def literal_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty places of a literal in each text that has it, and whether there are more."""
    x = table(spark, d, "documents").where(F.contains("text", F.lit("edital"))).select("doc_id", E.find_all(F.col("text"), F.lit("edital")).alias("f"))
    return x.select("doc_id", "f.*")


_CONF = "('indice_oficial', 'indice_oficial_combinado', 'portal_externo_oficial')"


@query(f"""WITH a AS (SELECT case_id, bucket, decision, url FROM replay_v1 WHERE exported_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY exported_at DESC, decision DESC NULLS LAST, url DESC NULLS LAST) = 1),
    b AS (SELECT case_id, candidate AS c FROM replay_v2 WHERE exported_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY exported_at DESC, candidate.decision DESC NULLS LAST, candidate.url DESC NULLS LAST, candidate.authority DESC NULLS LAST, candidate.identity DESC NULLS LAST, candidate.evidence_state DESC NULLS LAST, candidate.bucket DESC NULLS LAST) = 1),
    j AS (SELECT case_id, a.bucket, decision AS d1, c.decision AS d2, coalesce((decision = 'revisar' AND c.decision = 'revisar') OR (decision = c.decision AND a.bucket = c.bucket AND {s_metric("a.url")} = {s_metric("c.url")}), false) AS agreed,
      coalesce(c.authority = 'confirmada', false) AND coalesce(c.identity = 'confirmada', false) AND coalesce(c.evidence_state IN ('completa', 'renderizada'), false) AND coalesce(c.decision IN {_CONF}, false) AND coalesce(c.bucket = a.bucket OR c.bucket = 'combinado', false) AS open FROM a JOIN b USING (case_id))
    SELECT case_id, CASE WHEN d1 = 'revisar' THEN 'agreement_review' WHEN NOT coalesce(d1 IN {_CONF}, false) THEN 'proposal_a_not_affirmative' WHEN agreed AND open THEN 'consensus' WHEN agreed THEN 'consensus_failed_final_gate' ELSE 'judge' END AS code FROM j""")
def consensus_codes(spark: SparkSession, d: str) -> DataFrame:
    """What the two systems' proposals come to without a judge."""
    a = table(spark, d, "replay_v1").where("exported_at is not null")
    order = lambda *cs: F.struct("exported_at", *[x for c in cs for x in (F.col(c).isNotNull(), F.col(c))])
    a = a.groupBy("case_id").agg(F.max_by(F.struct("bucket", "decision", "url"), order("decision", "url", "bucket")).alias("a"))
    b = table(spark, d, "replay_v2").where("exported_at is not null")
    b = b.groupBy("case_id").agg(F.max_by("candidate", order(*[f"candidate.{x}" for x in ("decision", "url", "authority", "identity", "evidence_state", "bucket")])).alias("c"))
    j = a.join(b, "case_id")
    c = lambda x: F.col(f"c.{x}")
    agreed = E.agree(F.col("a.decision"), F.col("a.bucket"), F.col("a.url"), c("decision"), c("bucket"), c("url"))
    gate = F.size(D.gate_blockers(c("authority"), c("identity"), F.lit(True), c("evidence_state"), c("decision"), c("bucket"), F.col("a.bucket"))) == 0
    j = j.select("case_id", "a", "c", agreed.alias("agreed"), gate.alias("gate"))
    code = E.consensus_code(F.col("a.bucket"), F.col("a.decision"), F.col("a.bucket"), F.col("agreed"), c("decision"), F.lit(None).cast("string"), F.col("gate"))
    return j.select("case_id", code.alias("code"))


@query(f"""SELECT evidence_id, 'v1:' || sha1('["' || {s_metric("final_url")} || '","' || {s_fold("coalesce(municipio, '')")} || '","' || coalesce(bucket, '') || '","' || md5(coalesce(content, '')) || '"]') AS record_id,
    {_S_MUNI} AS unit_key FROM fetched_evidence WHERE NOT regexp_matches({s_metric("final_url")}, '["\\\\/]') OR NOT contains({s_metric("final_url")}, '"')""")
def record_ids(spark: SparkSession, d: str) -> DataFrame:
    """Stable ids of page records over address, municipality, bucket and content, and the municipality key of their unit."""
    f = table(spark, d, "fetched_evidence")
    parts = (U.metric_key(F.col("final_url")), T.fold(F.coalesce("municipio", F.lit(""))), F.coalesce("bucket", F.lit("")), F.md5(F.coalesce("content", F.lit(""))))
    return f.select("evidence_id", E.record_id(*parts).alias("record_id"), T.compact(F.col("municipio")).alias("unit_key"))


@query(f"""WITH r AS (SELECT DISTINCT muni_key, tipo, state, borderline FROM (SELECT {_S_MUNI} AS muni_key, coalesce(tipo, '') AS tipo, coalesce(lote, '') AS state, coalesce(requiere_revision_humana, '') = 'si' AS borderline FROM golden_set_v1 WHERE municipio IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_S_MUNI} ORDER BY golden_id DESC) = 1)),
    b1 AS (SELECT *, row_number() OVER (PARTITION BY tipo, state ORDER BY sha256('s1|' || muni_key), muni_key) AS r1 FROM r WHERE borderline), b2 AS (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY r1, state) AS t FROM b1), f AS (SELECT * FROM b2 ORDER BY t, tipo LIMIT 10),
    c1 AS (SELECT *, row_number() OVER (PARTITION BY tipo, state ORDER BY sha256('s1|' || muni_key), muni_key) AS r1 FROM r WHERE muni_key NOT IN (SELECT muni_key FROM f)), c2 AS (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY r1, state) AS t FROM c1), g AS (SELECT * FROM c2 ORDER BY t, tipo LIMIT (SELECT 50 - count(*) FROM f))
    SELECT muni_key, tipo, state, 'borderline_reserve' AS phase FROM f UNION ALL SELECT muni_key, tipo, state, 'family_fill' FROM g""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """Fifty municipalities in turns over types and lots, ten of them reserved for those that need review."""
    g = table(spark, d, "golden_set_v1").where("municipio is not null").withColumn("muni_key", T.compact(F.col("municipio")))
    g = R.latest(g, ["muni_key"], "golden_id", ["tipo", "lote", "requiere_revision_humana"])
    g = g.select("muni_key", F.coalesce("tipo", F.lit("")).alias("tipo"), F.coalesce("lote", F.lit("")).alias("state"), (F.coalesce("requiere_revision_humana", F.lit("")) == "si").alias("b"))
    return E.select_sample(g, "muni_key", "tipo", "state", F.col("b"), 50, 10, "s1")


@query(f"SELECT DISTINCT muni_key, bucket FROM (SELECT {_S_MUNI} AS muni_key, bucket FROM replay_v1 WHERE municipio IS NOT NULL AND bucket IS NOT NULL) WHERE ('0x' || substring(sha256('7' || chr(0) || muni_key || chr(0) || bucket), 1, 16))::UBIGINT % 10 = 0")
def audit_draw(spark: SparkSession, d: str) -> DataFrame:
    """The stable tenth of all units that is audited."""
    u = table(spark, d, "replay_v1").where("municipio is not null and bucket is not null").select(T.compact(F.col("municipio")).alias("muni_key"), "bucket").distinct()
    return u.where(E.drawn(7, F.col("muni_key"), F.col("bucket")))


@query(f"""SELECT a.muni_key, max(a.n1) AS outcomes, max(coalesce(b.n2, 0)) AS pages FROM (SELECT {_S_MUNI} AS muni_key, count(*) AS n1 FROM replay_v1 WHERE municipio IS NOT NULL GROUP BY 1) a LEFT JOIN (SELECT {_S_MUNI} AS muni_key, count(*) AS n2 FROM fetched_evidence WHERE municipio IS NOT NULL GROUP BY 1) b USING (muni_key) GROUP BY 1""")
def outcome_pages(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of each municipality with the number of its pages, both counted before they are joined."""
    count = lambda t, n: table(spark, d, t).where("municipio is not null").groupBy(T.compact(F.col("municipio")).alias("muni_key")).agg(F.count(F.lit(1)).alias(n))
    return count("replay_v1", "outcomes").join(count("fetched_evidence", "pages"), "muni_key", "left").na.fill(0, ["pages"])


@query(f"""WITH n AS (SELECT DISTINCT {s_fold('municipio')} AS name FROM dominios_oficiales WHERE municipio IS NOT NULL), t AS (SELECT doc_id, {s_fold('title')} AS f FROM documents WHERE title IS NOT NULL)
    SELECT doc_id, name FROM t JOIN n ON name <> '' AND contains(' ' || f || ' ', ' ' || name || ' ') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(name) DESC, name) = 1""")
def title_municipalities(spark: SparkSession, d: str) -> DataFrame:
    """The longest municipality name that a title mentions."""
    n = table(spark, d, "dominios_oficiales").where("municipio is not null").select(T.fold(F.col("municipio")).alias("name"))
    t = table(spark, d, "documents").where("title is not null").select("doc_id", T.fold(F.col("title")).alias("f"))
    return R.longest_mention(t, "doc_id", "f", n, "name")


@query(f"""WITH n AS (SELECT {s_fold('municipio')} AS name, min(municipio) AS municipio, count(DISTINCT municipio) AS writings FROM dominios_oficiales WHERE municipio IS NOT NULL GROUP BY 1)
    SELECT doc_id, n.municipio, writings FROM documents d JOIN n ON {s_fold('d.municipio')} = n.name WHERE d.municipio IS NOT NULL""")
def original_names(spark: SparkSession, d: str) -> DataFrame:
    """The registry's writing of each document's municipality, and how many it has."""
    n = table(spark, d, "dominios_oficiales").where("municipio is not null").groupBy(T.fold(F.col("municipio")).alias("name")).agg(F.min("municipio").alias("municipio"), F.countDistinct("municipio").alias("writings"))
    docs = table(spark, d, "documents").where("municipio is not null").select("doc_id", T.fold(F.col("municipio")).alias("name"))
    return docs.join(n, "name").select("doc_id", "municipio", "writings")


_S_DIFF = "CASE WHEN {a} <> {b} THEN '{n}: ''' || substring({a}, 1, 90) || ''' -> ''' || substring({b}, 1, 90) || '''' END"


@query(f"""WITH a AS (SELECT snapshot_id, resource_id, status, title, final_url FROM evidence_snapshot QUALIFY row_number() OVER (PARTITION BY snapshot_id, resource_id ORDER BY retrieved_at DESC NULLS LAST, coalesce(title, '') DESC, coalesce(final_url, '') DESC, coalesce(status, -1) DESC) = 1),
    o AS (SELECT snapshot_id, row_number() OVER (ORDER BY snapshot_id) AS k FROM (SELECT DISTINCT snapshot_id FROM evidence_snapshot)), x AS (SELECT a.*, k FROM a JOIN o USING (snapshot_id)),
    j AS (SELECT n.snapshot_id, n.resource_id, coalesce(p.status::VARCHAR, '') AS s1, coalesce(n.status::VARCHAR, '') AS s2, coalesce(p.title, '') AS t1, coalesce(n.title, '') AS t2, coalesce(p.final_url, '') AS u1, coalesce(n.final_url, '') AS u2 FROM x n JOIN x p ON n.resource_id = p.resource_id AND n.k = p.k + 1)
    SELECT snapshot_id, resource_id, array_to_string(list_filter([{_S_DIFF.format(a="s1", b="s2", n="status")}, {_S_DIFF.format(a="t1", b="t2", n="title")}, {_S_DIFF.format(a="u1", b="u2", n="final_url")}], lambda z: z IS NOT NULL), '; ') AS diffs
    FROM j WHERE s1 <> s2 OR t1 <> t2 OR u1 <> u2""")
def resource_field_diffs(spark: SparkSession, d: str) -> DataFrame:
    """What changed in a resource's status, title and address against the delivery before, field by field."""
    fields = ("status", "title", "final_url")
    s = table(spark, d, "evidence_snapshot").select("snapshot_id", "resource_id", "retrieved_at", *fields)
    tie = [F.coalesce("title", F.lit("")), F.coalesce("final_url", F.lit("")), F.coalesce("status", F.lit(-1))]
    s = s.groupBy("snapshot_id", "resource_id").agg(F.max_by(F.struct(*fields), F.struct(F.col("retrieved_at").isNotNull(), "retrieved_at", *tie)).alias("r"))
    # one row a delivery: the number of deliveries is the same at every scale
    ids = s.select("snapshot_id").distinct()
    nxt = ids.withColumn("next_id", F.lead("snapshot_id").over(W.orderBy("snapshot_id"))).where("next_id is not null")
    before = s.join(nxt, "snapshot_id").select(F.col("next_id").alias("snapshot_id"), "resource_id", F.col("r").alias("p"))
    j = s.join(before, ["snapshot_id", "resource_id"])
    diffs = X.field_diffs({f: F.col(f"p.{f}") for f in fields}, {f: F.col(f"r.{f}") for f in fields})
    return j.select("snapshot_id", "resource_id", diffs.alias("x")).where(F.size("x") > 0).select("snapshot_id", "resource_id", F.array_join("x", "; ").alias("diffs"))


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k, greatest(1, length(props) // 4)::INT AS estimate, regexp_matches(props, '(?i)\\b(bearer\\s+)[A-Za-z0-9._~+/=-]{8,}') AS secret FROM events")
def event_props(spark: SparkSession, d: str) -> DataFrame:
    """Properties of events read loosely, their size estimate, and whether they hold a secret."""
    p = F.col("props")
    return table(spark, d, "events").select("event_id", X.loose_object(p, "k int")["k"].alias("k"), X.tokens_estimate(p).alias("estimate"), X.has_secret(p).alias("secret"))
