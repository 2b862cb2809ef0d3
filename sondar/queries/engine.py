"""Queries of the engine's own operators, over whole tables, each with its DuckDB equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondar.functions import html as H
from sondar.functions import numbers as N
from sondar.functions import pages as P
from sondar.functions import text as T
from sondar.functions import urls as U
from sondar.operators import citations as C
from sondar.operators import decisions as D
from sondar.operators import lines as L
from sondar.operators import relational as R
from sondar.plans.tables import table
from sondar.queries.general import _sql_key
from sondar.streaming import quota as Q

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- SQL text shared by the oracles


def s_plain(x: str) -> str:
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F) if chr(c) != "＇")
    return f"strip_accents(translate({x}, 'ºª²³¹{wide}', 'oa231{"".join(chr(ord(c) - 0xFEE0) for c in wide)}'))"


def s_fold(x: str) -> str:
    return f"trim(regexp_replace(lower({s_plain(x)}), '[^a-z0-9]+', ' ', 'g'))"


def s_any(x: str, phrases) -> str:
    return "coalesce(" + " OR ".join(f"contains({x}, '{p}')" for p in phrases) + ", false)"


def s_host(x: str) -> str:
    return f"regexp_replace(lower(regexp_extract(trim(coalesce({x}, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*://)?(?:[^/@?#]*@)?([^/:?#]*)', 1)), '\\.$', '')"


def s_bare(x: str) -> str:
    return f"regexp_replace({s_host(x)}, '^www\\.', '')"


def s_path(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*://)?[^/?#]*([^?#]*)', 1)"


def s_query(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), '\\?([^#]*)', 1)"


def s_unescape(x: str) -> str:
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')" if b != "'" else f"replace({x}, '{a}', '''')"
    return x


def s_metric(x: str) -> str:
    """The metric key, from the address as written; no package pattern takes part."""
    u = f"CASE WHEN contains(coalesce({x}, ''), '://') THEN trim({x}) ELSE 'http://' || trim(coalesce({x}, '')) END"
    host = f"regexp_replace(lower(regexp_extract({u}, '^[^:/?#]*://([^/?#]*)', 1)), '^www\\.', '')"
    path = f"regexp_replace(regexp_extract({u}, '^[^:/?#]*://[^/?#]*([^?#]*)', 1), '/+$', '')"
    part = "list_filter(string_split(regexp_extract({u}, '\\?([^#]*)', 1), '&'), lambda p: p <> '')".format(u=u)
    pairs = f"list_sort(list_transform({part}, lambda p: {{'k': url_decode(replace(split_part(p, '=', 1), '+', ' ')), 'v': url_decode(replace(CASE WHEN contains(p, '=') THEN regexp_replace(p, '^[^=]*=', '') ELSE '' END, '+', ' '))}}))"
    query = f"array_to_string(list_transform({pairs}, lambda q: lower(q.k) || '=' || q.v), '&')"
    return f"(CASE WHEN lower(trim(coalesce({x}, ''))) IN ('', 'no_existe') THEN '' ELSE {host} || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END)"


def s_key_host(k: str) -> str:
    return f"split_part(split_part({k}, '?', 1), '/', 1)"


S_ANCHOR = r"""(?is)<a\s[^>]*href=["'']([^"'']+)["''][^>]*>(.*?)</a>"""
_CONN = "('da', 'de', 'do', 'das', 'dos')"
_STOP = "('municipio', 'municipal', 'prefeitura', 'camara', 'concurso', 'concursos', 'publico', 'processo', 'seletivo', 'edital', 'para', 'como', 'simplificado')"

# --- text

_S_SQUEEZED = "trim(regexp_replace(coalesce(title, ''), '[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}\\x{3000}]+', ' ', 'g'))"


@query(f"""SELECT golden_id, {s_fold("municipio")} AS folded, replace({s_fold("municipio")}, ' ', '-') AS slug,
    array_to_string(list_filter(string_split({s_fold("municipio")}, ' '), lambda w: w NOT IN {_CONN}), '') AS plain_slug,
    regexp_replace(lower({s_plain("municipio")}), '[^a-z0-9]', '', 'g') AS muni_key FROM golden_set_v1""")
def names_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Municipality names as fold, slugs and join key."""
    m = F.col("municipio")
    return table(spark, d, "golden_set_v1").select("golden_id", T.fold(m).alias("folded"), T.slug(m).alias("slug"), T.slug_plain(m).alias("plain_slug"), T.compact(m).alias("muni_key"))


@query(f"""SELECT doc_id, trim(regexp_replace(translate(lower({s_plain("title")}), '°', 'o'), '\\s+', ' ', 'g')) AS match_form,
    CASE WHEN length({_S_SQUEEZED}) > 40 THEN substring({_S_SQUEEZED}, 1, 40) || '...' ELSE {_S_SQUEEZED} END AS short_title,
    list_distinct_ordered AS tokens, (letters > 0 AND caps >= 0.72 * letters) AS mostly_upper FROM (SELECT *,
      list_filter(f, lambda w, i: list_position(f, w) = i) AS list_distinct_ordered FROM (SELECT *,
      list_filter(string_split({s_fold("title")}, ' '), lambda w: length(w) >= 4 AND w NOT IN {_STOP}) AS f,
      length(regexp_replace({s_plain("title")}, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace({s_plain("title")}, '[^A-Z]', '', 'g')) AS caps FROM documents))""")
def titles_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Titles as match form, cut form, identity tokens and a test for capitals."""
    t = F.col("title")
    return table(spark, d, "documents").select("doc_id", T.match_form(t).alias("match_form"), T.ellipsis(t, 40).alias("short_title"), T.identity_tokens(t).alias("tokens"), T.mostly_upper(t).alias("mostly_upper"))


@query("""SELECT doc_id, (k * 12000)::INT AS start, sha256(substring(text, k * 12000 + 1, 14000)) AS window_hash FROM (
    SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) > 14000 THEN (length(text) + 11999) // 12000 ELSE 1 END)) AS k FROM documents WHERE text IS NOT NULL)""")
def text_windows(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping windows of 14000 characters, every 12000, to the end of the text."""
    w = F.explode(T.windows(F.col("text"))).alias("w")
    return table(spark, d, "documents").where("text is not null").select("doc_id", w).select("doc_id", F.col("w.start").alias("start"), F.sha2(F.col("w.text"), 256).alias("window_hash"))


@query("""SELECT doc_id, substring(text, a, p - a + 6 + 40) AS around FROM (SELECT doc_id, text, instr(text, 'edital') AS p, greatest(instr(text, 'edital') - 40, 1) AS a FROM documents) WHERE p > 0""")
def text_around(spark: SparkSession, d: str) -> DataFrame:
    """Forty characters to either side of the first "edital"."""
    return table(spark, d, "documents").select("doc_id", T.around(F.col("text"), "edital", 40).alias("around")).where("around is not null")


@query(f"""SELECT doc_id, lower(regexp_replace({s_plain("coalesce(title, '')")}, '[^\\x00-\\x7F]', '', 'g')) AS plain_quote, regexp_replace(coalesce(bucket, ''), '[^A-Za-z0-9_.\\-]+', '_', 'g') AS label,
    CASE WHEN length({_S_SQUEEZED}) > 60 THEN substring({_S_SQUEEZED}, 1, 60) || ' [...]' ELSE {_S_SQUEEZED} END AS bounded, CASE WHEN contains({s_fold("coalesce(title, '')")}, 'processo seletivo') OR contains({s_fold("coalesce(title, '')")}, 'pss') OR contains({s_fold("coalesce(title, '')")}, 'seletivo simplificado') OR contains({s_fold("coalesce(title, '')")}, 'selecao publica') THEN 'processo_seletivo' ELSE 'concurso_publico' END AS tipo
    FROM documents WHERE NOT regexp_matches(coalesce(title, ''), '[ÃÂ]')""")
def title_forms(spark: SparkSession, d: str) -> DataFrame:
    """Titles in the form quotes are compared in, as a file label, bounded, and the type of announcement they name; titles with marks of a wrong encoding are left to quote_form's tests."""
    t = F.col("title")
    x = table(spark, d, "documents").where(~F.coalesce(t.rlike("[ÃÂ]"), F.lit(False)))
    f = T.fold(F.coalesce(t, F.lit("")))
    quote = F.lower(F.regexp_replace(T.unaccent(F.coalesce(t, F.lit(""))), "[^\\x{00}-\\x{7F}]", ""))
    return x.select("doc_id", quote.alias("plain_quote"), T.file_label(F.coalesce("bucket", F.lit(""))).alias("label"), T.ellipsis(t, 60, " [...]").alias("bounded"), F.when(T.contains_any(f, ("processo seletivo", "pss", "seletivo simplificado", "selecao publica")), "processo_seletivo").otherwise("concurso_publico").alias("tipo"))


# --- addresses


@query(f"""SELECT evidence_id, {_sql_key("final_url")} AS url_key, {s_host("final_url")} AS host_name, {s_bare("final_url")} AS bare_host,
    regexp_replace(lower(regexp_replace(final_url, '[?#].*$', '')), '/+$', '') AS no_query, regexp_replace(final_url, '#.*$', '') AS no_fragment,
    regexp_matches({s_bare("final_url")}, '^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$') AS is_ip FROM fetched_evidence""")
def url_keys(spark: SparkSession, d: str) -> DataFrame:
    """Canonical keys and hosts of addresses."""
    u = F.col("final_url")
    return table(spark, d, "fetched_evidence").select("evidence_id", U.url_key(u).alias("url_key"), U.host(u).alias("host_name"), U.bare_host(u).alias("bare_host"), U.without_query(u).alias("no_query"), U.without_fragment(u).alias("no_fragment"), U.is_ip(u).alias("is_ip"))


@query(f"""WITH k AS (SELECT evidence_id, requested_url, {_sql_key("requested_url")} AS k FROM fetched_evidence), p AS (SELECT *, list_filter(string_split(regexp_extract(k, '\\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(ano|year)=(0|todos|todas)?$')) AS ps FROM k)
    SELECT evidence_id, regexp_replace(k, '\\?.*$', '') || CASE WHEN len(ps) > 0 THEN '?' || array_to_string(ps, '&') ELSE '' END AS default_free,
      CASE WHEN regexp_matches(requested_url, '[?&]ano=[1-9][0-9]{{3}}(&|#|$)') THEN regexp_replace(requested_url, '([?&]ano=)[1-9][0-9]{{3}}', '\\10') END AS all_years,
      regexp_replace(regexp_replace(requested_url, '://[^/@?#]+@', '://***@', 'g'), '(?i)([?&](?:token|key|api_key|senha|password|sig|session|id)=)[^&#]*', '\\1***', 'g') AS redacted FROM p""")
def url_variants(spark: SparkSession, d: str) -> DataFrame:
    """Addresses without default parameters, over all years, and with secrets hidden."""
    u = F.col("requested_url")
    return table(spark, d, "fetched_evidence").select("evidence_id", U.without_defaults(u).alias("default_free"), U.all_years(u).alias("all_years"), U.redacted(u).alias("redacted"))


_S_CLEAN = "regexp_replace(CASE WHEN trim(coalesce({x}, '')) <> '' AND NOT contains({x}, '://') THEN 'http://' || trim({x}) ELSE trim(coalesce({x}, '')) END, '/+$', '')"
_S_FU = "coalesce(final_url, '')"


@query(f"""SELECT evidence_id, lower(regexp_replace({s_path(_S_CLEAN.format(x="final_url"))}, '^/+|/+$', '', 'g')) IN ('', 'web', 'home', 'inicio', 'index.php', 'index.html', 'portal', 'site') AS landing,
    regexp_matches(lower({s_path("final_url")}), '\\.(pdf|doc|docx|xls|xlsx)$') AS file_url, regexp_matches(lower({_S_FU}), '/id/[0-9]+|/detalhe/|/legislacao/detalhe|[?&]slug=|\\.pdf(\\?|$)') AS hard_detail,
    regexp_matches(lower({_S_FU}), '/id/[0-9]+|/detalhe/|/legislacao/detalhe|[?&]slug=|\\.pdf(\\?|$)|/conteudos?/[0-9]+') AS detail, {s_any(f'lower({s_path("final_url")})', ("concurso", "seletivo", "selecoes", "edital", "pss"))} AS keyword,
    CASE WHEN regexp_extract({_S_FU}, '(?:ano|year)=((?:19|20)[0-9]{{2}})', 1) <> '' THEN regexp_extract(final_url, '(?:ano|year)=((?:19|20)[0-9]{{2}})', 1)::INT END AS url_year,
    {s_any(s_host("final_url"), ("facebook.", "instagram.", "youtube.", "twitter.", "x.com", "linkedin.", "acheconcursos.", "pciconcursos.", "qconcursos.", "google.", "bing.", "duckduckgo."))} AS never_official
    FROM fetched_evidence""")
def url_flags(spark: SparkSession, d: str) -> DataFrame:
    """What an address is by itself."""
    u = F.col("final_url")
    return table(spark, d, "fetched_evidence").select("evidence_id", P.landing(u).alias("landing"), P.file_url(u).alias("file_url"), U.hard_detail(u).alias("hard_detail"), U.maybe_detail(u).alias("detail"), P.keyword_url(u).alias("keyword"), P.url_year(u).alias("url_year"), U.listed_host(u).alias("never_official"))


@query(f"""WITH s AS (SELECT evidence_id, regexp_extract(requested_url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, list_filter(string_split(regexp_replace({s_path("requested_url")}, '^/|/$', '', 'g'), '/'), lambda x: x <> '') AS g FROM fetched_evidence)
    SELECT evidence_id, root || '/' || array_to_string(g[1:len(g) - k], '/') AS parent FROM s, (VALUES (1), (2)) r(k) WHERE len(g) - k >= 2""")
def url_parents(spark: SparkSession, d: str) -> DataFrame:
    """Parent pages with at least two path segments, two levels up at most."""
    return table(spark, d, "fetched_evidence").select("evidence_id", F.explode(U.parents(F.col("requested_url"))).alias("parent"))


@query("""WITH r AS (SELECT DISTINCT regexp_replace(host, '^www\\.', '') AS s FROM dominios_oficiales WHERE host IS NOT NULL), h AS (SELECT DISTINCT host FROM fetched_evidence WHERE host IS NOT NULL)
    SELECT host, max_by(s, length(s)) AS registered FROM h JOIN r ON h.host = r.s OR h.host LIKE '%.' || r.s GROUP BY host""")
def host_suffix_join(spark: SparkSession, d: str) -> DataFrame:
    """Hosts with their longest registered suffix."""
    reg = table(spark, d, "dominios_oficiales").where("host is not null").select(F.regexp_replace("host", r"^www\.", "").alias("s"))
    return R.suffix_join(table(spark, d, "fetched_evidence").where("host is not null"), reg, "host", "s")


@query(f"""SELECT DISTINCT {s_bare("pagina_oficial")} AS host FROM concursos_base WHERE coalesce(pagina_oficial, '') <> '' AND {s_bare("pagina_oficial")} NOT IN (SELECT {s_bare("host")} FROM dominios_oficiales WHERE host IS NOT NULL)""")
def hosts_unregistered(spark: SparkSession, d: str) -> DataFrame:
    """Hosts of announcements' pages that the registry doesn't hold, www and port apart."""
    t = table(spark, d, "concursos_base").where("coalesce(pagina_oficial, '') != ''").select(U.bare_host(F.col("pagina_oficial")).alias("host")).distinct()
    return t.join(table(spark, d, "dominios_oficiales").select(U.bare_host(F.col("host")).alias("host")), "host", "left_anti")


@query(f"""WITH m AS (SELECT DISTINCT regexp_replace(lower({s_plain("municipio")}), '[^a-z0-9]', '', 'g') AS muni_key FROM golden_set_v1 WHERE municipio IS NOT NULL)
    SELECT muni_key, s || '://' || p || muni_key || '.gov.example' AS candidate FROM m, (VALUES ('http'), ('https')) a(s), (VALUES ('www.'), ('pm'), ('')) b(p) WHERE muni_key <> ''""")
def candidate_domains(spark: SparkSession, d: str) -> DataFrame:
    """Addresses at which a municipality's site may be found."""
    m = table(spark, d, "golden_set_v1").where("municipio is not null").select(T.compact(F.col("municipio")).alias("muni_key")).distinct().where("muni_key != ''")
    forms = F.array(*[F.concat(F.lit(f"{s}://{p}"), "muni_key", F.lit(".gov.example")) for s in ("http", "https") for p in ("www.", "pm", "")])
    return m.select("muni_key", F.explode(forms).alias("candidate"))


_S_RK = "list_sort(list_filter(string_split(regexp_extract({u}, '\\?([^#]*)', 1), '&'), lambda p: p <> ''))"


@query(f"""SELECT evidence_id, {s_metric("final_url")} AS metric_key, {s_key_host(s_metric("final_url"))} AS key_host, {_S_CLEAN.format(x="final_url")} AS cleaned, regexp_extract(coalesce(final_url, ''), '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]+)', 1) AS host_base,
    starts_with(lower(trim(coalesce(final_url, ''))), 'http') AS has_http, {s_metric("requested_url")} = {s_metric("final_url")} AS same_resource, {s_bare("requested_url")} = {s_bare("final_url")} AS same_host,
    regexp_matches(lower(split_part(url_decode(lower(coalesce(final_url, ''))), '?', 1)), '\\.(pdf|doc|docx)$') AS document,
    CASE WHEN regexp_matches({s_host("final_url")}, '^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$') THEN 'ipv4:' || regexp_extract({s_host("final_url")}, '^([0-9]+\\.[0-9]+\\.[0-9]+)', 1) || '.0/24' ELSE 'host:' || {s_host("final_url")} END AS freeze_group
    FROM fetched_evidence""")
def resource_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys by which addresses are compared, and what an address says of its host."""
    u, r = F.col("final_url"), F.col("requested_url")
    x = table(spark, d, "fetched_evidence").select("evidence_id", u, r, U.metric_key(u).alias("metric_key"), U.metric_key(r).alias("rk"))
    return x.select("evidence_id", "metric_key", U.key_host(F.col("metric_key")).alias("key_host"), U.clean_url(u).alias("cleaned"), U.host_base(u).alias("host_base"), U.has_http(u).alias("has_http"), (F.col("rk") == F.col("metric_key")).alias("same_resource"), (U.bare_host(r) == U.bare_host(u)).alias("same_host"), U.document_url(u).alias("document"), U.freeze_group(u).alias("freeze_group"))


@query()
def reach_keys(spark: SparkSession, d: str) -> DataFrame:
    """Whether the requested address reaches the final page, parameters that mean all years apart; long addresses cut, viewers unwrapped."""
    u, r = F.col("final_url"), F.col("requested_url")
    return table(spark, d, "fetched_evidence").select("evidence_id", F.coalesce(U.same_page(r, u), F.lit(False)).alias("reaches"), U.bounded_url(u, 60).alias("short_url"), U.unwrapped(u).alias("document_url"))


@query()
def provider_links(spark: SparkSession, d: str) -> DataFrame:
    """The provider whose announcement a link leads to, and its page there; empty for links to no known provider."""
    u = F.col("edital_abertura_url")
    return table(spark, d, "concursos_base").select("base_id", U.provider_of(u).alias("provider"), U.provider_page(u).alias("page"))


# --- page source


@query(f"""SELECT evidence_id, trim({s_unescape("regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)")}) AS page_title, trim({s_unescape("regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)")}) AS heading,
    list_filter(list_transform(regexp_extract_all(html, '(?is)<h[1-4]\\b[^>]*>(.*?)</h[1-4]>', 1), lambda h: trim(regexp_replace({s_unescape("regexp_replace(h, '<[^>]+>', ' ', 'g')")}, '\\s+', ' ', 'g'))), lambda h: length(h) BETWEEN 6 AND 180) AS headings,
    len(list_distinct(list_transform(regexp_extract_all(html, 'https?://[^\\s"''<>)]+'), lambda u: regexp_replace(u, '[.,;]+$', ''))))::INT AS named_urls,
    md5(trim(regexp_replace({s_unescape("regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g'))) AS text_hash FROM fetched_evidence WHERE html <> ''""")
def page_fields(spark: SparkSession, d: str) -> DataFrame:
    """Title, heading and visible text of the source."""
    h = F.col("html")
    return table(spark, d, "fetched_evidence").where("html != ''").select("evidence_id", H.title(h).alias("page_title"), H.heading(h).alias("heading"), H.headings(h).alias("headings"), F.size(H.bare_urls(h)).alias("named_urls"), F.md5(H.text(h)).alias("text_hash"))


_S_LABEL = f"""trim(regexp_replace({s_unescape(f"regexp_replace(regexp_extract(a, '{S_ANCHOR}', 2), '<[^>]+>', '', 'g')")}, '\\s+', ' ', 'g'))"""
_S_ANCHORS = f"""SELECT evidence_id, pos, regexp_extract(a, '{S_ANCHOR}', 1) AS href, {_S_LABEL} AS label, requested_url FROM (
    SELECT evidence_id, requested_url, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM (SELECT evidence_id, requested_url, regexp_extract_all(html, '{S_ANCHOR}') AS l FROM fetched_evidence WHERE html <> ''))"""


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "fetched_evidence").where("html != ''").select("evidence_id", "requested_url", F.posexplode(H.anchors(F.col("html"))).alias("p", "a"))
    return a.select("evidence_id", (F.col("p") + 1).cast("bigint").alias("pos"), "a.href", "a.label", "requested_url")


@query(f"""SELECT evidence_id, min(pos) AS first_pos, CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN regexp_extract(requested_url, '^(https?://[^/?#]+)', 1) || href END AS link, count(*) AS times
    FROM ({_S_ANCHORS}) WHERE href <> '' GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY evidence_id, link"))
def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Distinct absolute links of a page with their first position and count."""
    a = _anchors(spark, d).where("href != ''").withColumn("link", H.absolute(F.col("href"), F.col("requested_url")))
    return a.groupBy("evidence_id", "link").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("times"))


@query(f"""SELECT evidence_id, pos, label FROM (SELECT *, row_number() OVER (PARTITION BY evidence_id ORDER BY pos) AS rn FROM ({_S_ANCHORS}) WHERE {s_any(s_fold("label") + " || ' ' || lower(href)", ("concurso", "seletivo", "selecoes", "edital", "pss"))}) WHERE rn <= 4""")
def container_links(spark: SparkSession, d: str) -> DataFrame:
    """The first four links of a page whose label or path names an announcement."""
    a = _anchors(spark, d).where(T.contains_any(F.concat(T.fold(F.col("label")), F.lit(" "), F.lower("href")), P.KEYWORDS))
    return a.withColumn("rn", F.row_number().over(W.partitionBy("evidence_id").orderBy("pos"))).where("rn <= 4").select("evidence_id", "pos", "label")


@query(f"""SELECT href, label, count(DISTINCT evidence_id) AS page_count FROM ({_S_ANCHORS}) GROUP BY href, label HAVING count(DISTINCT evidence_id) > 1""")
def shared_menu_entries(spark: SparkSession, d: str) -> DataFrame:
    """Links that several pages have."""
    return _anchors(spark, d).select("href", "label", "evidence_id").distinct().groupBy("href", "label").agg(F.count(F.lit(1)).alias("page_count")).where("page_count > 1")


# --- page predicates


def _s_th(n: int) -> str:
    return s_fold(f"coalesce(title, '') || ' ' || substring(coalesce(content, ''), 1, {n})")


_S_OK = "(status IS NULL OR status BETWEEN 200 AND 399)"
_S_SIGNS = ("security checkpoint", "vercel security", "just a moment", "checking your browser", "attention required", "cloudflare", "verifying you are human", "enable javascript and cookies")
_S_ITEMS = "len(list_distinct(regexp_extract_all(lower(strip_accents(substring(coalesce(content, ''), 1, 2500))), '((?:edital|concurso|processo|retificacao|convocacao|certame)[^0-9\n]{0,20}[0-9]{1,4}/[0-9]{4})', 1)))"
_S_WALLS = ("usa cookies", "utiliza cookies", "aceitar cookies", "aceite os cookies", "faca seu login", "habilite o javascript", "enable javascript", "ative o javascript", "ativar o javascript")
_S_AUDIT = ("um momento", "just a moment", "verificacao de seguranca", "verificando seguranca", "checking your browser", "cf browser verification", "attention required", "enable javascript and cookies to continue", "ddos guard", "needs to review the security")
_S_ERRORS = ("server error in", "runtime error", "application error", "erro de execucao", "internal server error", "http error 500", "service unavailable", "error 503", "could not connect", "error establishing a database", "exception details")
_S_SOFT = ("pagina nao encontrada", "nao encontramos", "erro 404", "error 404", "not found", "pagina inexistente", "conteudo nao encontrado")
_S_PARKED = ("em construcao", "em manutencao", "hospedagem de site", "dominio gratis", "registre seu dominio", "compre este dominio", "domain for sale")


@query(f"""SELECT evidence_id, {_S_OK} AS page_ok, NOT {_S_OK} OR {s_any(_s_th(500), _S_SOFT)} AS soft404, {s_any(_s_th(800), _S_PARKED)} AS parked,
    {s_any("lower(title)", _S_SIGNS)} OR {s_any("lower(content)", _S_SIGNS)} OR {s_any("lower(html)", _S_SIGNS)} AS challenged,
    {s_any("lower(substring(html, 1, 200000))", ("challenge-platform", "/cdn-cgi/challenge", "_cf_chl_opt", "cf_chl_", "ddos-guard"))} OR ({s_any("lower(title)", ("one moment, please", "just a moment", "checking your browser", "attention required"))} AND length(coalesce(content, '')) < 1500) AS guarded,
    {s_any(_s_th(600), _S_AUDIT)} AS audit_challenge, {s_any(_s_th(600), _S_ERRORS)} AS server_error, {s_any(_s_th(400), ("pagina nao encontrada", "page not found", "404 not found", "erro 404", "conteudo nao encontrado"))} AS not_found,
    coalesce(status IN (429, 503), false) OR {s_any(s_fold("substring(html, 1, 5000)"), ("wordfence", "acesso a este site foi limitado", "maximum number of page requests", "page requests per minute"))} AS blocked,
    length(coalesce(content, '')) <= 2500 AND {_S_ITEMS} < 2 AND {s_any(s_fold("substring(coalesce(content, ''), 1, 2500)"), _S_WALLS)} AS walled,
    {s_any("translate(lower(content), 'ãáâéêíóôõúç', 'aaaeeiooouc')", ("nenhum registro encontrado", "nao ha certames", "sem editais publicados", "nenhum resultado"))} AS no_events,
    trim(coalesce(content, '')) <> '' AND length(coalesce(content, '')) - length(replace(coalesce(content, ''), chr(10), '')) >= 3 AS complete FROM fetched_evidence""")
def page_flags(spark: SparkSession, d: str) -> DataFrame:
    """What a page is by its status, title, text and source. Heads are folded once, each list is one pass."""
    s, t, c, h = F.col("status"), F.col("title"), F.col("content"), F.col("html")
    # only short texts that speak of cookies, a login or scripts can be walls
    short = (F.length(F.coalesce(c, F.lit(""))) <= 2500) & F.coalesce(c.rlike("(?i)cookies|login|javascript"), F.lit(False))
    low = {f"l_{n}": F.lower(n) for n in ("title", "content", "html")}
    x = table(spark, d, "fetched_evidence").select("evidence_id", "status", "content", "html", *[e.alias(n) for n, e in low.items()], *[P.title_and_head(t, c, n).alias(f"h{n}") for n in (400, 500, 600, 800)], F.when(short, T.fold(c)).otherwise("").alias("wall"), F.when(short, N.distinct_items(F.lower(T.unaccent(c)))).otherwise(0).alias("items"))
    lt, lc, lh = F.col("l_title"), F.col("l_content"), F.col("l_html")
    flags = {
        "page_ok": P.ok(s),
        "soft404": P.soft404(s, F.col("h500")),
        "parked": T.holds(F.col("h800"), P.PARKED),
        "challenged": P.challenged(lt, lc, lh),
        "guarded": P.guarded(lt, c, lh),
        "audit_challenge": T.holds(F.col("h600"), P.AUDIT_CHALLENGE),
        "server_error": T.holds(F.col("h600"), P.SERVER_ERROR),
        "not_found": T.holds(F.col("h400"), P.NOT_FOUND),
        "blocked": P.blocked(s, h),
        "walled": P.walled(c, F.col("wall"), F.col("items")),
        "no_events": P.no_events(c),
        "complete": P.complete(c),
    }
    return x.select("evidence_id", *[f.alias(n) for n, f in flags.items()])


_S_LINKS = f"len(list_distinct(list_filter(regexp_extract_all(coalesce(html, ''), '{S_ANCHOR}', 1), lambda h: starts_with(h, 'http'))))"


@query(f"""WITH x AS (SELECT evidence_id, {s_any("lower(substring(html, 1, 200000))", ("__next_data__", "/_next/", "window.__nuxt__", "data-reactroot", 'id="__nuxt"'))} AS fw, {_S_LINKS} AS links,
      {_S_OK} AND length(coalesce(html, '')) >= 2000 AND length(trim(coalesce(content, ''))) < 500 AND coalesce(regexp_matches(html, '(?i)<script[^>]+\\bsrc\\s*='), false) AS thin FROM fetched_evidence)
    SELECT evidence_id, CASE WHEN fw AND links < 8 THEN 'app_shell' WHEN thin THEN 'thin_shell' WHEN links >= 8 THEN 'navigated' ELSE 'plain' END AS shell FROM x""")
def page_shells(spark: SparkSession, d: str) -> DataFrame:
    """Shells of script applications, by framework marks, links, scripts and text."""
    h = F.coalesce("html", F.lit(""))
    links = F.size(F.array_distinct(F.filter(F.transform(H.anchors(h), lambda a: a["href"]), lambda x: x.startswith("http"))))
    x = table(spark, d, "fetched_evidence").select("evidence_id", links.alias("links"), P.thin_shell(F.col("status"), F.col("content"), F.col("html")).alias("thin"), "html")
    kind = R.first_rule([("app_shell", P.app_shell(F.col("html"), F.col("links"))), ("thin_shell", F.col("thin")), ("navigated", F.col("links") >= 8)], "plain")
    return x.select("evidence_id", kind.alias("shell"))


# --- numbers


_S_KEY = "(?:^|[^0-9./])([0-9]{1,4})\\s*[/-]\\s*(20[12][0-9])\\b"
_S_SHORT = "(?i)(?:edital|concursos?|processos?\\s+seletiv\\w*|sele[cç][aã]o|\\bpss\\b|\\bn(?:[º°]|o)?\\b)(?:[^0-9]{0,23}?[^0-9./])?([0-9]{1,4})\\s*[/-]\\s*([0-9]{2})\\b(\\s*[/-]\\s*[0-9]{2,4}\\b)?"


def _s_num(x: str, out: str) -> str:
    a, b = (f"regexp_extract({x}, '{_S_KEY}', {k})" for k in (1, 2))
    c, e, tail = (f"regexp_extract({x}, '{_S_SHORT}', {k})" for k in (1, 2, 3))
    if out == "number":
        return f"CASE WHEN {a} <> '' THEN {a}::INT WHEN {c} <> '' AND {tail} = '' THEN {c}::INT END"
    return f"CASE WHEN {a} <> '' THEN {b}::INT WHEN {c} <> '' AND {tail} = '' THEN {e}::INT + CASE WHEN {e}::INT <= 39 THEN 2000 ELSE 1900 END END"


@query(f"""SELECT doc_id, {_s_num("title", "number")} AS number, {_s_num("title", "year")} AS year FROM documents""")
def number_keys(spark: SparkSession, d: str) -> DataFrame:
    """Number and year named in a title."""
    k = N.number_key(F.col("title"))
    return table(spark, d, "documents").select("doc_id", k["number"].alias("number"), k["year"].alias("year"))


@query()
def number_forms(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of a document by each of the reading rules; SQL's patterns have no look-around, so tests compare them with plain ones."""
    x = table(spark, d, "documents").select("doc_id", "title", T.match_form(F.col("title")).alias("m"), T.match_form(N.head_lines(F.col("text"))).alias("h"), T.match_form(F.substring("text", 1, 1200)).alias("s"), N.own_key(F.col("text")).alias("own"))
    audit = F.coalesce(*[F.nullif(N.context_label(F.col(c)), F.lit("")) for c in ("m", "h", "s")], F.lit(""))
    return x.select("doc_id", N.number_label(F.col("title")).alias("label"), N.named_label(F.col("title")).alias("named"), N.parts_label(F.col("m")).alias("parts"), N.titled_label(F.col("m")).alias("titled"), audit.alias("audit"), F.col("own.number").alias("own_number"), F.col("own.year").alias("own_year"))


_S_ITEM_TEXT = f"lower({s_plain('text')})"


@query(f"""SELECT doc_id, len(list_distinct(regexp_extract_all({_S_ITEM_TEXT}, '((?:edital|concurso|processo|retificacao|convocacao|certame)[^0-9\n]{{0,20}}[0-9]{{1,4}}/[0-9]{{4}})', 1)))::INT AS items FROM documents WHERE text IS NOT NULL""")
def distinct_items(spark: SparkSession, d: str) -> DataFrame:
    """Number of distinct announcement items named in a text."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", N.distinct_items(F.lower(T.unaccent(F.col("text")))).alias("items"))


@query(f"""SELECT b.base_id, count(*) AS radar_rows FROM concursos_base b JOIN concursos_radar r ON {_s_num("b.numero", "number")} = {_s_num("r.numero", "number")} AND {_s_num("b.numero", "year")} = {_s_num("r.numero", "year")}
    AND b.edital_abertura_url = r.edital_abertura_url GROUP BY b.base_id""")
def number_and_url_join(spark: SparkSession, d: str) -> DataFrame:
    """Exact join of both announcement tables on number, year and address."""
    b, r = table(spark, d, "concursos_base"), table(spark, d, "concursos_radar")
    k = lambda: N.number_key(F.col("numero"))
    b = b.select("base_id", k()["number"].alias("n"), k()["year"].alias("y"), "edital_abertura_url")
    r = r.select(k()["number"].alias("n"), k()["year"].alias("y"), "edital_abertura_url")
    return b.join(r, ["n", "y", "edital_abertura_url"]).groupBy("base_id").agg(F.count(F.lit(1)).alias("radar_rows"))


# --- lines


_S_LINES = "SELECT evidence_id, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (SELECT evidence_id, string_split(content, chr(10)) AS l FROM fetched_evidence WHERE content IS NOT NULL)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fetched_evidence").where("content is not null").select("evidence_id", L.lines(F.col("content")).alias("ls"))


@query(f"""SELECT evidence_id, line_no::INT AS line_no, near::INT AS near FROM (SELECT *, sum((length(line) BETWEEN 3 AND 30)::INT) OVER (PARTITION BY evidence_id ORDER BY line_no ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS near FROM ({_S_LINES})) WHERE near >= 10""")
def nav_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Lines among at least ten short ones within six lines."""
    x = _lines(spark, d).select("evidence_id", L.marked(F.col("ls"), lambda x: F.length(x).between(3, 30)).alias("marks"))
    return x.select("evidence_id", F.posexplode(L.near_counts(F.col("marks"), 6, 6)).alias("p", "near")).where("near >= 10").select("evidence_id", (F.col("p") + 1).alias("line_no"), "near")


_S_NUMLINE = f"regexp_matches(line, '{_S_KEY}')"


@query(f"""SELECT evidence_id, line_no::INT AS line_no, parent FROM (SELECT *, last_value(CASE WHEN {_S_NUMLINE} THEN line END IGNORE NULLS) OVER (PARTITION BY evidence_id ORDER BY line_no ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS parent FROM ({_S_LINES}))
    WHERE parent IS NOT NULL AND regexp_matches(line, '^(Baixar|Anexo|Arquivo)')""")
def parent_above(spark: SparkSession, d: str) -> DataFrame:
    """Attachments with the nearest numbered line above, within nine lines."""
    above = L.last_above(F.col("ls"), F.col("marks"), 9)
    x = _lines(spark, d).select("evidence_id", "ls", L.marked(F.col("ls"), lambda x: x.rlike(N.KEY)).alias("marks")).select("evidence_id", F.posexplode(F.arrays_zip(F.col("ls").alias("line"), above.alias("parent"))).alias("p", "z"))
    return x.where(F.col("z.parent").isNotNull() & F.col("z.line").rlike("^(Baixar|Anexo|Arquivo)")).select("evidence_id", (F.col("p") + 1).alias("line_no"), "z.parent")


@query(f"""SELECT evidence_id, min(line_no)::INT AS first_line, count(*)::INT AS line_count FROM (SELECT *, sum({_S_NUMLINE}::INT) OVER (PARTITION BY evidence_id ORDER BY line_no) AS block FROM ({_S_LINES})) WHERE block > 0 GROUP BY evidence_id, block""")
def number_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of lines, each from a numbered line to the next."""
    x = _lines(spark, d).select("evidence_id", L.starts(F.col("ls"), lambda x: x.rlike(N.KEY)).alias("at"), F.size("ls").alias("n"))
    return x.select("evidence_id", F.explode(L.blocks(F.col("at"), F.col("n"))).alias("b")).select("evidence_id", "b.first_line", "b.line_count")


@query(f"""SELECT evidence_id, line_no::INT AS line_no, below FROM (SELECT *, first_value(CASE WHEN regexp_matches(line, '^(Publicado em|Situação|Inscrições)') THEN line END IGNORE NULLS) OVER (PARTITION BY evidence_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS below FROM ({_S_LINES}))
    WHERE below IS NOT NULL AND {_S_NUMLINE}""")
def meta_below(spark: SparkSession, d: str) -> DataFrame:
    """Numbered lines with the nearest line of metadata below, within fourteen lines."""
    below = L.first_below(F.col("ls"), F.col("marks"), 14)
    x = _lines(spark, d).select("evidence_id", "ls", L.marked(F.col("ls"), lambda x: x.rlike("^(Publicado em|Situação|Inscrições)")).alias("marks")).select("evidence_id", F.posexplode(F.arrays_zip(F.col("ls").alias("line"), below.alias("below"))).alias("p", "z"))
    return x.where(F.col("z.below").isNotNull() & F.col("z.line").rlike(N.KEY)).select("evidence_id", (F.col("p") + 1).alias("line_no"), "z.below")


@query(f"""SELECT evidence_id, line_no::INT AS line_no, md5(string_agg(line, chr(10)) OVER (PARTITION BY evidence_id ORDER BY line_no ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)) AS context_hash FROM ({_S_LINES}) QUALIFY {_S_NUMLINE}""")
def line_contexts(spark: SparkSession, d: str) -> DataFrame:
    """The lines around each numbered line, seven above to six below."""
    ctx = L.within(F.col("ls"), 7, 6)
    x = _lines(spark, d).select("evidence_id", F.posexplode(F.arrays_zip(F.col("ls").alias("line"), ctx.alias("ctx"))).alias("p", "z"))
    return x.where(F.col("z.line").rlike(N.KEY)).select("evidence_id", (F.col("p") + 1).alias("line_no"), F.md5("z.ctx").alias("context_hash"))


@query(f"""SELECT evidence_id, min(line_no)::INT AS title_line FROM (SELECT l.*, f.title FROM ({_S_LINES}) l JOIN fetched_evidence f USING (evidence_id)) WHERE title <> '' AND contains(line, title) GROUP BY evidence_id""")
def title_lines(spark: SparkSession, d: str) -> DataFrame:
    """The first line that holds the page's title."""
    at = L.first_with(L.lines(F.col("content")), F.col("title")).alias("title_line")
    return table(spark, d, "fetched_evidence").select("evidence_id", at).where("title_line is not null")


# --- truth and outcomes


_S_MUNI = f"regexp_replace(lower({s_plain('municipio')}), '[^a-z0-9]', '', 'g')"
_S_TRUTH = f"""SELECT muni_key, bucket, CASE bucket WHEN 'concurso_publico' THEN url_concursos ELSE url_processos_seletivos END AS truth_url, CASE bucket WHEN 'concurso_publico' THEN urls_concursos_extra ELSE urls_processos_extra END AS extra, requiere_revision_humana, tipo FROM (
    SELECT *, {_S_MUNI} AS muni_key FROM golden_set_v1 WHERE municipio IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_S_MUNI} ORDER BY golden_id DESC) = 1), (VALUES ('concurso_publico'), ('processo_seletivo')) b(bucket)"""
_S_OUT = f"""SELECT {_S_MUNI} AS muni_key, bucket, url, decision FROM replay_v1 WHERE municipio IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_S_MUNI}, bucket ORDER BY exported_at DESC NULLS LAST, case_id DESC, url DESC NULLS LAST, decision DESC NULLS LAST) = 1"""


def _truth(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "golden_set_v1").where("municipio is not null").withColumn("muni_key", T.compact(F.col("municipio")))
    g = R.latest(g, ["muni_key"], "golden_id", ["url_concursos", "url_processos_seletivos", "urls_concursos_extra", "urls_processos_extra", "requiere_revision_humana", "tipo"])
    both = F.array(*[F.struct(F.lit(b).alias("bucket"), F.col(m).alias("truth_url"), F.col(e).alias("extra")) for b, m, e in (("concurso_publico", "url_concursos", "urls_concursos_extra"), ("processo_seletivo", "url_processos_seletivos", "urls_processos_extra"))])
    return g.select("muni_key", "requiere_revision_humana", "tipo", F.explode(both).alias("b")).select("muni_key", "requiere_revision_humana", "tipo", "b.*")


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "replay_v1").where("municipio is not null").withColumn("muni_key", T.compact(F.col("municipio")))
    best = F.max_by(F.struct("url", "decision"), F.struct(F.col("exported_at").isNotNull(), "exported_at", "case_id", "url", "decision"))
    return o.groupBy("muni_key", "bucket").agg(best.alias("r")).select("muni_key", "bucket", "r.url", "r.decision")


_S_JUDGED = f"""SELECT t.*, o.url, o.decision, list_filter([{s_metric("truth_url")}, {s_metric("extra")}], lambda k: k <> '') AS ks, {s_metric("o.url")} AS k,
    lower(trim(coalesce(truth_url, ''))) = 'no_existe' OR lower(trim(coalesce(extra, ''))) = 'no_existe' AS gone FROM ({_S_TRUTH}) t JOIN ({_S_OUT}) o USING (muni_key, bucket)"""
_S_VERDICT = f"""SELECT *, CASE WHEN len(ks) > 0 THEN CASE WHEN k = '' THEN 'MISS' WHEN list_contains(ks, k) THEN 'HIT' WHEN list_contains(list_transform(ks, lambda x: {s_key_host("x")}), {s_key_host("k")}) THEN 'HOST' ELSE 'WRNG' END
    WHEN gone THEN CASE WHEN k = '' THEN 'T-NEG' ELSE 'F-POS' END ELSE 'SKIP' END AS verdict FROM ({_S_JUDGED})"""


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    j = _truth(spark, d).join(_outcomes(spark, d), ["muni_key", "bucket"])
    return j.withColumn("verdict", D.truth_verdict(F.col("truth_url"), F.col("extra"), F.col("url")))


_S_KIND = "CASE WHEN {x} IN ('indice_oficial', 'indice_oficial_combinado', 'portal_externo_oficial') THEN 'confirm' WHEN {x} = 'revisar' THEN 'review' WHEN {x} = 'nao_encontrado' OR regexp_matches({x}, '_rechazad[oa]$') THEN 'negative' END"


@query(f"""SELECT muni_key, bucket, CASE WHEN list_filter([lower(trim(coalesce(truth_url, ''))), lower(trim(coalesce(extra, '')))], lambda v: v NOT IN ('', 'no_existe')) <> [] THEN 'confirm' WHEN gone THEN 'negative' ELSE 'golden_na' END AS expectation,
    CASE WHEN verdict = 'SKIP' THEN 'golden_na' WHEN verdict = 'HIT' AND {_S_KIND.format(x="decision")} = 'confirm' OR verdict = 'T-NEG' AND {_S_KIND.format(x="decision")} = 'negative' THEN 'match' ELSE 'differ' END AS compared FROM ({_S_VERDICT})""")
def truth_comparison(spark: SparkSession, d: str) -> DataFrame:
    """What truth expects of each unit, and whether the outcome matches it."""
    j = _truth(spark, d).join(_outcomes(spark, d), ["muni_key", "bucket"])
    t = (F.col("truth_url"), F.col("extra"))
    return j.select("muni_key", "bucket", D.truth_expectation(*t).alias("expectation"), D.compared_to_truth(F.col("decision"), F.col("url"), *t).alias("compared"))


@query(f"SELECT t.muni_key, t.bucket, coalesce(truth_url, '') AS truth_url FROM ({_S_TRUTH}) t WHERE NOT EXISTS (SELECT 1 FROM ({_S_OUT}) o WHERE o.muni_key = t.muni_key AND o.bucket = t.bucket)")
def truth_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Units of truth that no outcome answers."""
    t = _truth(spark, d)
    return t.join(_outcomes(spark, d).select("muni_key", "bucket"), ["muni_key", "bucket"], "left_anti").select("muni_key", "bucket", F.coalesce("truth_url", F.lit("")).alias("truth_url"))


@query(f"SELECT {_S_MUNI} AS muni_key, count(DISTINCT municipio) AS writings, min(municipio) AS one, max(municipio) AS other FROM golden_set_v1 WHERE municipio IS NOT NULL GROUP BY 1 HAVING count(DISTINCT municipio) > 1")
def key_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Names that share one municipality key."""
    g = table(spark, d, "golden_set_v1").where("municipio is not null").groupBy(T.compact(F.col("municipio")).alias("muni_key"))
    return g.agg(F.countDistinct("municipio").alias("writings"), F.min("municipio").alias("one"), F.max("municipio").alias("other")).where("writings > 1")


@query(f"SELECT muni_key, bucket, truth_url, url, verdict FROM ({_S_VERDICT})")
def truth_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes judged against curated truth."""
    return _verdicts(spark, d).select("muni_key", "bucket", "truth_url", "url", "verdict")


def _s_ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN round({a}::DOUBLE / {b}, 4) ELSE -1.0::DOUBLE END"


_S_COUNTS = ", ".join(f"count(*) FILTER (verdict = '{v}') AS {n}" for v, n in (("HIT", "hit"), ("HOST", "host"), ("WRNG", "wrng"), ("MISS", "miss"), ("T-NEG", "tneg"), ("F-POS", "fpos"), ("SKIP", "skip")))


@query(f"""SELECT bucket, hit, host, wrng, miss, tneg, fpos, skip, {_s_ratio("hit", "(hit + host + wrng + fpos)")} AS precision_strict, {_s_ratio("(hit + host)", "(hit + host + wrng + fpos)")} AS precision_lenient,
    {_s_ratio("hit", "(hit + host + wrng + miss)")} AS recall_strict, {_s_ratio("(hit + host)", "(hit + host + wrng + miss)")} AS recall_lenient, {_s_ratio("hit", "(hit + host)")} AS same_host_accuracy FROM (SELECT coalesce(bucket, 'all') AS bucket, {_S_COUNTS} FROM ({_S_VERDICT}) GROUP BY ROLLUP (bucket))""")
def precision_recall(spark: SparkSession, d: str) -> DataFrame:
    """Verdict counts with strict and lenient precision and recall, by bucket and over all."""
    names = {"HIT": "hit", "HOST": "host", "WRNG": "wrng", "MISS": "miss", "T-NEG": "tneg", "F-POS": "fpos", "SKIP": "skip"}
    g = _verdicts(spark, d).rollup("bucket").agg(*[F.count_if(F.col("verdict") == v).alias(n) for v, n in names.items()])
    c = {n: F.col(n) for n in names.values()}
    out = c["hit"] + c["host"] + c["wrng"] + c["fpos"]
    exists = c["hit"] + c["host"] + c["wrng"] + c["miss"]
    return g.select(F.coalesce("bucket", F.lit("all")).alias("bucket"), *names.values(), R.ratio(c["hit"], out).alias("precision_strict"), R.ratio(c["hit"] + c["host"], out).alias("precision_lenient"), R.ratio(c["hit"], exists).alias("recall_strict"), R.ratio(c["hit"] + c["host"], exists).alias("recall_lenient"), R.ratio(c["hit"], c["hit"] + c["host"]).alias("same_host_accuracy"))


@query(f"""SELECT coalesce(tipo, '') AS tipo, coalesce(requiere_revision_humana, '') = 'si' AS manual, verdict, count(*) AS n FROM ({_S_VERDICT}) GROUP BY 1, 2, 3""")
def verdicts_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Verdict counts by type of site and need of human review."""
    return _verdicts(spark, d).groupBy(F.coalesce("tipo", F.lit("")).alias("tipo"), (F.coalesce("requiere_revision_humana", F.lit("")) == "si").alias("manual"), "verdict").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH e AS (SELECT DISTINCT {_S_MUNI} AS k FROM golden_set_v1 WHERE municipio IS NOT NULL), c AS (SELECT DISTINCT {_S_MUNI} AS k FROM replay_v1 WHERE municipio IS NOT NULL), x AS (SELECT DISTINCT {_S_MUNI} AS k FROM dominios_oficiales WHERE municipio IS NOT NULL AND verificado_por = 'importacion')
    SELECT k AS muni_key, CASE WHEN e.e IS NULL THEN 'unexpected' WHEN c.c IS NOT NULL AND x.x IS NOT NULL THEN 'both' WHEN c.c IS NOT NULL THEN 'covered' WHEN x.x IS NOT NULL THEN 'excluded' ELSE 'missing' END AS state
    FROM (SELECT k, 1 AS e FROM e) e FULL JOIN (SELECT k, 1 AS c FROM c) c USING (k) FULL JOIN (SELECT k, 1 AS x FROM x) x USING (k)""")
def coverage_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Expected municipalities against covered and excluded ones."""
    key = lambda t: table(spark, d, t).where("municipio is not null").withColumn("muni_key", T.compact(F.col("municipio")))
    return R.reconcile(key("golden_set_v1"), key("replay_v1"), key("dominios_oficiales").where("verificado_por = 'importacion'"), "muni_key")


@query(f"""WITH m AS (SELECT DISTINCT {_S_MUNI} AS k FROM golden_set_v1 WHERE municipio IS NOT NULL), t AS (SELECT {s_metric("url_concursos")} AS k FROM golden_set_v1 UNION SELECT {s_metric("url_processos_seletivos")} FROM golden_set_v1 UNION SELECT {s_metric("site_base")} FROM golden_set_v1)
    SELECT evidence_id FROM fetched_evidence WHERE coalesce({_S_MUNI}, '') NOT IN (SELECT k FROM m) AND NOT EXISTS (SELECT 1 FROM t WHERE k <> '' AND k IN ({s_metric("requested_url")}, {s_metric("final_url")}))""")
def anti_truth(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose municipality truth doesn't have, and that share no resource with it."""
    g = table(spark, d, "golden_set_v1")
    m = g.where("municipio is not null").select(T.compact(F.col("municipio")).alias("k"))
    t = g.select(F.explode(F.array(*[U.metric_key(F.col(c)) for c in ("url_concursos", "url_processos_seletivos", "site_base")])).alias("k")).where("k != ''")
    f = table(spark, d, "fetched_evidence").select("evidence_id", F.coalesce(T.compact(F.col("municipio")), F.lit("")).alias("k"), U.metric_key(F.col("requested_url")).alias("k1"), U.metric_key(F.col("final_url")).alias("k2"))
    left = f.join(m, "k", "left_anti")
    for c in ("k1", "k2"):
        left = left.join(t.withColumnRenamed("k", c), c, "left_anti")
    return left.select("evidence_id")


_S_SIDE = "SELECT case_id, {d} AS dec, {u} AS url FROM {t} WHERE exported_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY exported_at DESC, {d} DESC NULLS LAST, {u} DESC NULLS LAST) = 1"
_S_PAIR = f"""SELECT case_id, a.dec AS d1, b.dec AS d2, {_S_KIND.format(x="a.dec")} AS k1, {_S_KIND.format(x="b.dec")} AS k2, {s_metric("a.url")} AS u1, {s_metric("b.url")} AS u2 FROM ({_S_SIDE.format(d="decision", u="url", t="replay_v1")}) a JOIN ({_S_SIDE.format(d="candidate.decision", u="candidate.url", t="replay_v2")}) b USING (case_id)"""
_S_RANK = "CASE {k} WHEN 'confirm' THEN 2 WHEN 'review' THEN 1 ELSE 0 END"
_S_FLIP = f"""SELECT *, CASE WHEN k1 IS NULL OR k2 IS NULL THEN NULL WHEN k1 = k2 THEN CASE k1 WHEN 'review' THEN 'both_review' WHEN 'negative' THEN 'both_negative' ELSE CASE WHEN u1 = u2 THEN 'both_confirm_same_resource' ELSE 'both_confirm_distinct_resource' END END
    WHEN {_S_RANK.format(k="k2")} > {_S_RANK.format(k="k1")} THEN 'v2_' || k2 || '_v1_' || k1 ELSE 'v1_' || k1 || '_v2_' || k2 END AS flip FROM ({_S_PAIR})"""


def _decided(spark: SparkSession, d: str) -> DataFrame:
    def side(t: str, dec: str, url: str, k: int) -> DataFrame:
        x = table(spark, d, t).where("exported_at is not null").select("case_id", "exported_at", F.col(dec).alias("dec"), F.col(url).alias("url"))
        # a null counts as least: it is told apart from an empty text
        order = F.struct("exported_at", F.col("dec").isNotNull(), "dec", F.col("url").isNotNull(), "url")
        x = x.groupBy("case_id").agg(F.max_by(F.struct("dec", "url"), order).alias("r"))
        return x.select("case_id", F.col("r.dec").alias(f"d{k}"), F.col("r.url").alias(f"u{k}"))

    j = side("replay_v1", "decision", "url", 1).join(side("replay_v2", "candidate.decision", "candidate.url", 2), "case_id")
    return j.withColumn("flip", D.flip_class(F.col("d1"), F.col("u1"), F.col("d2"), F.col("u2"))).withColumn("k1", D.decision_kind(F.col("d1"))).withColumn("k2", D.decision_kind(F.col("d2")))


@query(f"SELECT case_id, flip FROM ({_S_FLIP})")
def flip_classes(spark: SparkSession, d: str) -> DataFrame:
    """How a case's decision moved between the two systems, in ten classes; null where a decision is unknown."""
    return _decided(spark, d).select("case_id", "flip")


@query(f"SELECT count(flip) AS compared, count(*) - count(flip) AS skipped, count(*) FILTER (k1 <> k2) AS flips, count(*) FILTER ({_S_RANK.format(k='k2')} < {_S_RANK.format(k='k1')} AND flip IS NOT NULL) AS negative, count(*) FILTER ({_S_RANK.format(k='k2')} > {_S_RANK.format(k='k1')} AND flip IS NOT NULL) AS positive FROM ({_S_FLIP})")
def flip_counts(spark: SparkSession, d: str) -> DataFrame:
    """Cases compared, skipped, and moved down or up."""
    rank = lambda k: F.when(F.col(k) == "confirm", 2).when(F.col(k) == "review", 1).otherwise(0)
    known = F.col("flip").isNotNull()
    return _decided(spark, d).agg(F.count("flip").alias("compared"), F.count_if(~known).alias("skipped"), F.count_if(F.col("k1") != F.col("k2")).alias("flips"), F.count_if(known & (rank("k2") < rank("k1"))).alias("negative"), F.count_if(known & (rank("k2") > rank("k1"))).alias("positive"))


@query(f"""SELECT case_id, CASE WHEN cause = 'access_failure' THEN 'adquisicion' WHEN cause = 'legitimate_absence' THEN 'ausencia_legitima' WHEN d1 IS NULL THEN 'no_computable' WHEN flip IN ('both_confirm_same_resource', 'both_review', 'both_negative') THEN 'sin_discrepancia' ELSE 'semantico_real' END AS category
    FROM (SELECT f.*, CASE WHEN s = 'error_fetch' THEN 'access_failure' WHEN d2 = 'nao_encontrado' THEN 'legitimate_absence' ELSE 'success' END AS cause FROM ({_S_FLIP}) f
      JOIN (SELECT case_id, arg_max(candidate.evidence_state, row(exported_at, coalesce(candidate.decision, ''), coalesce(candidate.url, ''), coalesce(candidate.evidence_state, ''))) AS s FROM replay_v2 WHERE exported_at IS NOT NULL AND candidate IS NOT NULL GROUP BY 1) USING (case_id)) WHERE d2 IS NOT NULL""")
def discrepancy_classes(spark: SparkSession, d: str) -> DataFrame:
    """Why the systems differ; the second one's cause is read from its evidence and decision."""
    v2 = table(spark, d, "replay_v2").where("exported_at is not null and candidate is not null")
    c = lambda x: F.coalesce(F.col(f"candidate.{x}"), F.lit(""))
    s = v2.groupBy("case_id").agg(F.max_by("candidate.evidence_state", F.struct("exported_at", c("decision"), c("url"), c("evidence_state"))).alias("s"))
    x = _decided(spark, d).where("d2 is not null").join(s, "case_id")
    cause = F.when(F.col("s") == "error_fetch", "access_failure").when(F.col("d2") == "nao_encontrado", "legitimate_absence").otherwise("success")
    return x.select("case_id", D.discrepancy(F.col("d1").isNotNull(), F.lit(True), cause, F.lit(""), F.col("flip")).alias("category"))


@query(f"SELECT k1, count(*) FILTER (k2 = 'confirm') AS confirm, count(*) FILTER (k2 = 'review') AS review, count(*) FILTER (k2 = 'negative') AS negative FROM ({_S_PAIR}) WHERE k1 IS NOT NULL GROUP BY k1")
def discrepancy_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Decisions of one system against those of the other."""
    return _decided(spark, d).where("k1 is not null").groupBy("k1").agg(*[F.count_if(F.col("k2") == k).alias(k) for k in ("confirm", "review", "negative")])


_S_C = "coalesce(candidate.{f}, '')"
_S_ROLE = "CASE coalesce(candidate.decision, '') WHEN 'indice_oficial' THEN 'indice_listado' WHEN 'indice_oficial_combinado' THEN 'indice_combinado' WHEN 'portal_externo_oficial' THEN 'indice_listado' WHEN 'detalle_individual_rechazado' THEN 'detalle_individual' WHEN 'nao_encontrado' THEN 'noticia' ELSE 'desconocido' END"


@query(f"""WITH c AS (SELECT case_id, exported_at, {_S_C.format(f="source_kind")} AS k, {_S_C.format(f="authority")} AS a, {_S_C.format(f="identity")} AS i, {_S_C.format(f="evidence_state")} AS e, {_S_C.format(f="bucket")} AS b, {_S_ROLE} AS r, {_S_C.format(f="decision")} AS d FROM replay_v2)
    SELECT case_id, exported_at, CASE WHEN e NOT IN ('completa', 'renderizada', 'incompleta_antibot') THEN 'revisar' WHEN d = 'licitacao_rechazada' THEN 'licitacao_rechazada' WHEN d = 'concurso_cultural_rechazado' THEN 'concurso_cultural_rechazado' WHEN e = 'incompleta_antibot' THEN 'revisar'
      WHEN r = 'detalle_individual' THEN 'detalle_individual_rechazado' WHEN r NOT IN ('indice_listado', 'indice_combinado') THEN 'nao_encontrado' WHEN i <> 'confirmada' OR a <> 'confirmada' THEN 'revisar' WHEN k = 'portal_externo_delegado' THEN 'portal_externo_oficial'
      WHEN r = 'indice_combinado' OR b NOT IN ('concurso_publico', 'processo_seletivo') THEN 'indice_oficial_combinado' ELSE 'indice_oficial' END AS derived FROM c""")
def derived_decisions(spark: SparkSession, d: str) -> DataFrame:
    """The decision that the table of rules derives from a candidate's attributes; its role is read from the system's own decision."""
    c = lambda f: F.col(f"candidate.{f}")
    said = F.coalesce(c("decision"), F.lit(""))
    role = F.when(said.isin("indice_oficial", "portal_externo_oficial"), "indice_listado").when(said == "indice_oficial_combinado", "indice_combinado").when(said == "detalle_individual_rechazado", "detalle_individual").when(said == "nao_encontrado", "noticia").otherwise("desconocido")
    got = D.derived_decision(c("source_kind"), c("authority"), c("identity"), role, c("bucket"), c("evidence_state"), F.lit(True), said == "licitacao_rechazada", said == "concurso_cultural_rechazado")
    return table(spark, d, "replay_v2").select("case_id", "exported_at", got.alias("derived"))


@query("""WITH e AS (SELECT *, candidate.bucket = bucket AS own FROM replay_v2 WHERE candidate.decision IN ('indice_oficial', 'indice_oficial_combinado', 'portal_externo_oficial') AND (candidate.bucket = bucket OR candidate.bucket = 'combinado')),
    g AS (SELECT municipio, bucket, max(own) AS any_own FROM e GROUP BY 1, 2), p AS (SELECT e.* FROM e JOIN g ON e.municipio IS NOT DISTINCT FROM g.municipio AND e.bucket IS NOT DISTINCT FROM g.bucket WHERE own OR NOT any_own),
    s AS (SELECT municipio, bucket, count(*) AS n, min(candidate.candidate_id) AS lo, max(candidate.candidate_id) AS hi FROM p GROUP BY 1, 2), u AS (SELECT DISTINCT municipio, bucket FROM replay_v2)
    SELECT u.municipio, u.bucket, CASE WHEN lo = hi THEN lo END AS candidate_id, CASE WHEN n IS NULL THEN 'none_eligible' WHEN lo <> hi THEN 'tie' WHEN n > 1 THEN 'selected_duplicate' ELSE 'selected' END AS outcome FROM u LEFT JOIN s ON u.municipio IS NOT DISTINCT FROM s.municipio AND u.bucket IS NOT DISTINCT FROM s.bucket""")
def resolved_picks(spark: SparkSession, d: str) -> DataFrame:
    """The candidate selected for each municipality and bucket, or why there is none."""
    v2 = table(spark, d, "replay_v2").select("municipio", "bucket", F.col("candidate.candidate_id").alias("candidate_id"), F.col("candidate.bucket").alias("cb"), F.col("candidate.decision").alias("dec"))
    return D.resolved_picks(v2, ["municipio", "bucket"], "bucket", "candidate_id", "cb", "dec")


# --- states and rollups


_S_STATE = "CASE WHEN coalesce(requiere_revision_humana, '') = 'no' AND starts_with(lower(trim(coalesce({u}, ''))), 'http') THEN 'CONF' WHEN starts_with(lower(trim(coalesce({u}, ''))), 'http') THEN 'PEND' WHEN lower(trim(coalesce({u}, ''))) = 'no_existe' THEN 'VAC_VERIF' ELSE 'VAC_RAW' END"


@query(f"""WITH s AS (SELECT golden_id, {_S_STATE.format(u="url_concursos")} AS a, {_S_STATE.format(u="url_processos_seletivos")} AS b FROM golden_set_v1)
    SELECT golden_id, a, b, CASE WHEN a = 'CONF' AND b = 'CONF' THEN 'green' WHEN a = 'PEND' OR b = 'PEND' THEN 'amber' WHEN a = 'CONF' OR b = 'CONF' THEN 'closed' ELSE 'red' END AS state FROM s""")
def rollup_states(spark: SparkSession, d: str) -> DataFrame:
    """State of a municipality from the states of its two buckets; rows that need no review count as confirmed."""
    sure = F.when(F.col("requiere_revision_humana") == "no", "confirmado")

    def state(c: str, bucket: str):
        marker = F.when(F.lower(F.trim(F.col(c))) == "no_existe", F.lit(f"[sin_indice_oficial_chrome:{bucket}]"))
        return D.bucket_state(sure, F.col(c), marker, bucket)

    g = table(spark, d, "golden_set_v1").select("golden_id", state("url_concursos", "concursos").alias("a"), state("url_processos_seletivos", "processos").alias("b"))
    return g.withColumn("state", D.municipality_state(F.col("a"), F.col("b")))


@query(f"""SELECT coalesce(bucket, 'all') AS bucket, count(*) FILTER (s = 'CONF') AS confirmed, count(*) FILTER (s = 'PEND') AS pending, count(*) FILTER (s = 'VAC_RAW') AS vacant, count(*) FILTER (s = 'VAC_VERIF') AS verified_vacant FROM (
    SELECT 'concursos' AS bucket, {_S_STATE.format(u="url_concursos")} AS s FROM golden_set_v1 UNION ALL SELECT 'processos', {_S_STATE.format(u="url_processos_seletivos")} FROM golden_set_v1) GROUP BY ROLLUP (bucket)""")
def bucket_overview(spark: SparkSession, d: str) -> DataFrame:
    """Addresses by state, by bucket and over all."""
    g = rollup_states(spark, d).select(F.explode(F.array(F.struct(F.lit("concursos").alias("bucket"), F.col("a").alias("s")), F.struct(F.lit("processos").alias("bucket"), F.col("b").alias("s")))).alias("x")).select("x.*")
    names = {"CONF": "confirmed", "PEND": "pending", "VAC_RAW": "vacant", "VAC_VERIF": "verified_vacant"}
    return g.rollup("bucket").agg(*[F.count_if(F.col("s") == k).alias(n) for k, n in names.items()]).withColumn("bucket", F.coalesce("bucket", F.lit("all")))


@query(f"""SELECT coalesce(banca, '') AS banca, count(*) AS n, count(*) FILTER (semaforo = 'listo') AS ready, count(*) FILTER (coalesce(edital_abertura_url, '') <> '') AS with_url, {_s_ratio("count(*) FILTER (semaforo = 'listo')", "count(*)")} AS ready_rate
    FROM concursos_base GROUP BY 1""")
def rows_per_bank(spark: SparkSession, d: str) -> DataFrame:
    """Announcements of each bank, how many are ready and have an address."""
    g = table(spark, d, "concursos_base").groupBy(F.coalesce("banca", F.lit("")).alias("banca"))
    x = g.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("semaforo") == "listo").alias("ready"), F.count_if(F.coalesce("edital_abertura_url", F.lit("")) != "").alias("with_url"))
    return x.withColumn("ready_rate", R.ratio(F.col("ready"), F.col("n")))


@query("""SELECT coalesce(semaforo, '(all)') AS semaforo, coalesce(tipo, '(all)') AS tipo, count(*) AS n FROM (SELECT coalesce(semaforo, '') AS semaforo, coalesce(tipo, '') AS tipo FROM concursos_base) GROUP BY GROUPING SETS ((semaforo, tipo), (semaforo), ())""")
def state_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Counts by state and type, by state, and over all."""
    b = table(spark, d, "concursos_base").select(F.coalesce("semaforo", F.lit("")).alias("semaforo"), F.coalesce("tipo", F.lit("")).alias("tipo"))
    return b.rollup("semaforo", "tipo").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("semaforo", F.lit("(all)")).alias("semaforo"), F.coalesce("tipo", F.lit("(all)")).alias("tipo"), "n")


@query("SELECT municipio, count(DISTINCT host) AS hosts, array_to_string(list_sort(list(DISTINCT host)), ' | ') AS host_list FROM dominios_oficiales WHERE municipio IS NOT NULL GROUP BY municipio HAVING count(DISTINCT host) > 1")
def municipios_with_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Municipalities with several hosts, and their hosts in one string."""
    x = table(spark, d, "dominios_oficiales").where("municipio is not null").groupBy("municipio").agg(F.collect_set("host").alias("s"))
    return x.where(F.size("s") > 1).select("municipio", F.size("s").cast("bigint").alias("hosts"), F.array_join(F.array_sort("s"), " | ").alias("host_list"))


@query("SELECT requested_url, final_url, status, count(*) AS occurrences, min(evidence_id) AS first_id FROM fetched_evidence GROUP BY requested_url, final_url, status HAVING count(*) > 1")
def collapse_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Repeated fetches as one row with their number."""
    return table(spark, d, "fetched_evidence").groupBy("requested_url", "final_url", "status").agg(F.count(F.lit(1)).alias("occurrences"), F.min("evidence_id").alias("first_id")).where("occurrences > 1")


@query("""SELECT snapshot_id, sha256(string_agg(part::VARCHAR || ':' || digest, ',' ORDER BY part)) AS digest, sum(n)::BIGINT AS rows_in FROM (
    SELECT snapshot_id, resource_id // 1024 AS part, sha256(string_agg(resource_id::VARCHAR || ':' || h, ',' ORDER BY resource_id, h)) AS digest, count(*) AS n FROM (SELECT snapshot_id, resource_id, md5(coalesce(content, '')) AS h FROM evidence_snapshot) GROUP BY 1, 2) GROUP BY 1""")
def snapshot_digests(spark: SparkSession, d: str) -> DataFrame:
    """One digest a delivery: of ranges of 1024 keys over their sorted (resource, content hash) pairs, then of the ranges' digests."""

    def digest(parts, key: str, value: str):
        return F.sha2(F.array_join(F.transform(F.array_sort(parts), lambda x: F.concat(x[key].cast("string"), F.lit(":"), x[value])), ","), 256)

    s = table(spark, d, "evidence_snapshot").select("snapshot_id", F.expr("resource_id div 1024").alias("part"), F.struct("resource_id", F.md5(F.coalesce("content", F.lit(""))).alias("h")).alias("x"))
    g = s.groupBy("snapshot_id", "part").agg(digest(F.collect_list("x"), "resource_id", "h").alias("digest"), F.count(F.lit(1)).alias("n"))
    return g.groupBy("snapshot_id").agg(digest(F.collect_list(F.struct("part", "digest")), "part", "digest").alias("digest"), F.sum("n").alias("rows_in"))


_S_FAMILY = "CASE WHEN host LIKE '%.portal-unificado.example' THEN 'unified' WHEN host LIKE '%.atende-cidade.example' THEN 'hosted' WHEN contains(coalesce(requested_url, ''), '/arquivo/secao/') THEN 'sections' WHEN host LIKE '%.gov.example' THEN 'official' ELSE 'other' END"


def _family():
    h, u = F.col("host"), F.coalesce("requested_url", F.lit(""))
    return R.first_rule([("unified", h.endswith(".portal-unificado.example")), ("hosted", h.endswith(".atende-cidade.example")), ("sections", F.contains(u, F.lit("/arquivo/secao/"))), ("official", h.endswith(".gov.example"))], "other")


@query(f"SELECT {_S_FAMILY} AS family, count(*) AS n, count(DISTINCT host) AS hosts FROM fetched_evidence GROUP BY 1")
def host_families(spark: SparkSession, d: str) -> DataFrame:
    """Pages by family of portal; the first rule that holds decides."""
    return table(spark, d, "fetched_evidence").groupBy(_family().alias("family")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("host").alias("hosts"))


# --- selection and sampling


@query(f"""SELECT evidence_id, family, turn::INT AS turn FROM (SELECT evidence_id, {_S_FAMILY} AS family, row_number() OVER (PARTITION BY {_S_FAMILY} ORDER BY sha256('s1|' || evidence_id::VARCHAR)) AS turn FROM fetched_evidence) ORDER BY turn, family LIMIT 60""")
def stratified_round_robin(spark: SparkSession, d: str) -> DataFrame:
    """Sixty pages taken in turns from the families, in a stable random order."""
    f = table(spark, d, "fetched_evidence").select("evidence_id", _family().alias("family"))
    return R.round_robin(f, "family", [F.sha2(F.concat(F.lit("s1|"), F.col("evidence_id").cast("string")), 256)], 60).select("evidence_id", "family", "turn")


@query("SELECT doc_id FROM documents WHERE ('0x' || substring(sha256('s1|' || doc_id::VARCHAR), 1, 8))::BIGINT % 10 = 0")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """A stable tenth of the documents."""
    return table(spark, d, "documents").where(R.hash_share(F.col("doc_id").cast("string"), "s1", 10)).select("doc_id")


@query("SELECT base_id, coalesce(banca, '') AS banca, rank::INT AS rank FROM (SELECT base_id, banca, row_number() OVER (PARTITION BY coalesce(banca, '') ORDER BY (semaforo = 'listo') DESC NULLS LAST, (coalesce(edital_abertura_url, '') <> '') DESC, coalesce(orgao, ''), base_id) AS rank FROM concursos_base) WHERE rank <= 3 ORDER BY coalesce(banca, ''), rank LIMIT 40")
def per_bank_limits(spark: SparkSession, d: str) -> DataFrame:
    """Three announcements a bank, ready ones with an address first, forty in all."""
    b = table(spark, d, "concursos_base").withColumn("banca", F.coalesce("banca", F.lit("")))
    order = [(F.col("semaforo") == "listo").desc_nulls_last(), (F.coalesce("edital_abertura_url", F.lit("")) != "").desc(), F.coalesce("orgao", F.lit("")), F.col("base_id")]
    return R.top_per_group(b, "banca", order, 3, 40).select("base_id", "banca", "rank")


_S_SCORE = f"(CASE WHEN {s_any(s_fold('label'), ('edital', 'abertura'))} THEN 10 ELSE 0 END + CASE WHEN {s_any(s_fold('label'), ('retificacao', 'gabarito', 'resultado', 'lista'))} THEN -8 ELSE 0 END + CASE WHEN regexp_matches(label, '{_S_KEY}') THEN 3 ELSE 0 END)"


@query(f"SELECT evidence_id, pos, label, score::INT AS score FROM (SELECT *, {_S_SCORE} AS score FROM ({_S_ANCHORS})) WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY evidence_id ORDER BY score DESC, length(href), length(label), pos) = 1")
def best_document_link(spark: SparkSession, d: str) -> DataFrame:
    """The best scored link of a page; short addresses and labels first among equals."""
    lab = T.fold(F.col("label"))
    score = F.when(T.contains_any(lab, ("edital", "abertura")), 10).otherwise(0) + F.when(T.contains_any(lab, ("retificacao", "gabarito", "resultado", "lista")), -8).otherwise(0) + F.when(F.col("label").rlike(N.KEY), 3).otherwise(0)
    a = _anchors(spark, d).withColumn("score", score).where("score > 0")
    return R.keep_one(a, ["evidence_id"], [F.desc("score"), F.length("href"), F.length("label"), F.col("pos")]).select("evidence_id", "pos", "label", "score")


# --- overlays and latest state


@query("SELECT resource_id, snapshot_id, status, md5(coalesce(content, '')) AS content_hash FROM evidence_snapshot QUALIFY row_number() OVER (PARTITION BY resource_id ORDER BY snapshot_id DESC, retrieved_at DESC NULLS LAST, md5(coalesce(content, '')) DESC, status DESC NULLS LAST) = 1")
def latest_per_resource(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of every resource; content is hashed before the shuffle."""
    s = table(spark, d, "evidence_snapshot").select("resource_id", "snapshot_id", "retrieved_at", "status", F.md5(F.coalesce("content", F.lit(""))).alias("content_hash"))
    best = F.max_by(F.struct("snapshot_id", "status", "content_hash"), F.struct("snapshot_id", F.col("retrieved_at").isNotNull(), "retrieved_at", "content_hash", "status"))
    return s.groupBy("resource_id").agg(best.alias("r")).select("resource_id", "r.*")


@query(f"""WITH o AS (SELECT {_S_MUNI} AS muni_key, host, 'registry' AS origin FROM dominios_oficiales WHERE municipio IS NOT NULL), n AS (SELECT DISTINCT {_S_MUNI} AS muni_key, {s_host("site_base")} AS host, 'truth' AS origin FROM golden_set_v1 WHERE municipio IS NOT NULL AND coalesce(site_base, '') <> '')
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE muni_key NOT IN (SELECT muni_key FROM n)""")
def overlay_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Hosts of truth over those of the registry, by municipality."""
    key = T.compact(F.col("municipio")).alias("muni_key")
    o = table(spark, d, "dominios_oficiales").where("municipio is not null").select(key, "host", F.lit("registry").alias("origin"))
    n = table(spark, d, "golden_set_v1").where("municipio is not null and coalesce(site_base, '') != ''").select(key, U.host(F.col("site_base")).alias("host"), F.lit("truth").alias("origin")).distinct()
    return R.overlay(o, n, ["muni_key"])


# --- evidence gates


_S_GATE = "list_filter([CASE WHEN coalesce(candidate.authority, '') <> 'confirmada' THEN 'authority' END, CASE WHEN coalesce(candidate.identity, '') <> 'confirmada' THEN 'identity' END, CASE WHEN coalesce(candidate.evidence_state, '') NOT IN ('completa', 'renderizada') THEN 'evidence_state' END], lambda x: x IS NOT NULL)"


@query(f"SELECT case_id, exported_at, array_to_string({_S_GATE}, ',') AS blockers, CASE WHEN len({_S_GATE}) = 0 THEN 'confirmado' ELSE 'revisar' END AS gate FROM replay_v2")
def final_gate(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with the gates they don't pass."""
    b = C.blockers(F.col("candidate.authority"), F.col("candidate.identity"), F.col("candidate.evidence_state"))
    return table(spark, d, "replay_v2").select("case_id", "exported_at", F.array_join(b, ",").alias("blockers"), F.when(F.size(b) == 0, "confirmado").otherwise("revisar").alias("gate"))


@query("""WITH q AS (SELECT evidence_id, content, title AS quote FROM fetched_evidence WHERE length(title) >= 8), n AS (SELECT *, CASE WHEN coalesce(content, '') = '' THEN 0 ELSE ((length(content) - length(replace(content, quote, ''))) / length(quote))::INT END AS n FROM q)
    SELECT evidence_id, CASE WHEN n = 1 THEN (instr(content, quote) - 1)::INT END AS start, CASE WHEN n = 1 THEN (instr(content, quote) - 1 + length(quote))::INT END AS stop,
      CASE WHEN coalesce(content, '') = '' THEN 'empty_source' WHEN n = 0 THEN 'quote_not_found' WHEN n > 1 THEN 'quote_ambiguous' END AS reason FROM n""")
def citation_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Where a page's title is cited literally in its text, if it is there exactly once."""
    q = table(spark, d, "fetched_evidence").where(F.length("title") >= 8)
    return q.select("evidence_id", C.anchored(F.col("content"), F.col("title")).alias("a")).select("evidence_id", "a.*")


# --- quotas on the event stream


_S_EV = "SELECT event_id, user_id, event_type, ts FROM events"


@query(f"SELECT event_id, count(*) OVER w AS calls_60s, sum(value) OVER w AS value_60s FROM (SELECT *, epoch_us(ts) AS us FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)".replace("sum(value) OVER w AS value_60s", "round(sum(value) OVER w, 4) AS value_60s"))
def rolling_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls and their sum in the last 60 seconds, the lower edge open."""
    x = Q.rolling_rows(table(spark, d, "events"), "event_type", "ts", 60, {"calls_60s": F.lit(1), "value_60s": F.col("value")})
    return x.select("event_id", "calls_60s", F.round("value_60s", 4).alias("value_60s"))


@query("SELECT user_id, day, n, n > 3 AS over_quota FROM (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2)")
def daily_quota(spark: SparkSession, d: str) -> DataFrame:
    """Calls a user and UTC day against a daily quota."""
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("over_quota", F.col("n") > 3)


@query("SELECT event_id, hits::INT AS hits, (CASE WHEN hits = 1 THEN 900 WHEN hits = 2 THEN 2700 ELSE -1 END)::INT AS freeze_s FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS hits FROM events WHERE event_type = (SELECT min(event_type) FROM events))")
def freeze_levels(spark: SparkSession, d: str) -> DataFrame:
    """Escalating freezes of a user at each hit of one type."""
    e = table(spark, d, "events")
    first = e.agg(F.min("event_type").alias("event_type"))
    hits = e.join(F.broadcast(first), "event_type").withColumn("hits", Q.attempts(["user_id"], ["ts", "event_id"]))
    return hits.select("event_id", "hits", Q.freeze_seconds(F.col("hits")).alias("freeze_s"))


@query("SELECT user_id, session::BIGINT AS session, count(*) AS n, min(ts) AS started, max(ts) AS ended FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 86400000000 THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY user_id, session")
def retry_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Runs of a user's events with gaps of a day at most."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag("ts").over(w)
    e = table(spark, d, "events").withColumn("fresh", F.when(before.isNull() | (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(before.cast("timestamp")) > 86_400_000_000), 1).otherwise(0))
    s = e.withColumn("session", F.sum("fresh").over(w))
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("started"), F.max("ts").alias("ended"))
