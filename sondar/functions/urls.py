"""URL keys as Column expressions (JVM side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\u0085   -     　﻿]"


def strip_ws(c: Column) -> Column:
    """c without leading and trailing white space of any kind; null stays null."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def url_key(c: Column) -> Column:
    """The part of a URL by which two writings count as the same address.

    Surrounding white space, scheme, one leading ``www.``, case of the host, a
    trailing slash, the order of query parameters and the fragment don't matter.
    Null and blank give the empty string.
    """
    s = strip_ws(F.coalesce(c, F.lit("")))
    s = F.regexp_replace(s, r"#.*$", "")
    s = F.regexp_replace(s, r"^(?i)[a-z][a-z0-9+.\-]*://|^//", "")
    host = F.lower(F.regexp_extract(s, r"^([^/?]*)", 1))
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(s, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(s, r"\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&", -1), lambda x: x != ""))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))


def host(c: Column) -> Column:
    """Lower-case host without port, user and final dot; empty if there is no address."""
    h = F.lower(F.regexp_extract(strip_ws(F.coalesce(c, F.lit(""))), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://)?(?:[^/@?#]*@)?([^/:?#]*)", 1))
    return F.regexp_replace(h, r"\.$", "")


def bare_host(c: Column) -> Column:
    return F.regexp_replace(host(c), r"^www\.", "")


def path(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://)?[^/?#]*([^?#]*)", 1)


def query(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"\?([^#]*)", 1)


def without_query(c: Column) -> Column:
    """Lower case, neither query nor fragment, no trailing slash."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"[?#].*$", "")), r"/+$", "")


def without_fragment(c: Column) -> Column:
    return F.regexp_replace(c, "#.*$", "")


def is_ip(c: Column) -> Column:
    return bare_host(c).rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")


def without_defaults(c: Column) -> Column:
    """url_key without ano/year parameters that mean all years."""
    k = url_key(c)
    parts = F.filter(F.split(F.regexp_extract(k, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike("^(ano|year)=(0|todos|todas)?$"))
    return F.concat(F.regexp_replace(k, r"\?.*$", ""), F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(F.lit("")))


def all_years(c: Column) -> Column:
    """The address with ano=YYYY replaced by ano=0; null where there is no such parameter."""
    return F.when(c.rlike(r"[?&]ano=[1-9][0-9]{3}(&|#|$)"), F.regexp_replace(c, r"([?&]ano=)[1-9][0-9]{3}", "$1" + "0"))


def parents(c: Column, most: int = 2) -> Column:
    """Up to `most` parent paths with at least two segments."""
    segs = F.filter(F.split(F.regexp_replace(path(c), "^/|/$", ""), "/"), lambda s: s != "")
    root = F.regexp_extract(c, r"^([a-zA-Z]+://[^/?#]+)", 1)
    ks = F.filter(F.transform(F.sequence(F.lit(1), F.lit(most)), lambda k: F.size(segs) - k), lambda n: n >= 2)
    return F.transform(ks, lambda n: F.concat(root, F.lit("/"), F.array_join(F.slice(segs, F.lit(1), n), "/")))


def redacted(c: Column) -> Column:
    """Values of parameters that may hold secrets, and credentials before the host, replaced."""
    c = F.regexp_replace(c, r"://[^/@?#]+@", "://***@")
    return F.regexp_replace(c, r"(?i)([?&](?:token|key|api_key|senha|password|sig|session|id)=)[^&#]*", "$1***")


def clean_url(c: Column) -> Column:
    """Trimmed, with a scheme, without trailing slashes; empty if there is nothing."""
    x = F.trim(F.coalesce(c, F.lit("")))
    x = F.when((x != "") & ~F.contains(x, F.lit("://")), F.concat(F.lit("http://"), x)).otherwise(x)
    return F.regexp_replace(x, "/+$", "")


def has_http(c: Column) -> Column:
    return F.startswith(F.lower(F.trim(F.coalesce(c, F.lit("")))), F.lit("http"))


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _pairs(query: Column) -> Column:
    """Sorted (name, value) pairs of a query, decoded; blank values are kept."""
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), F.when(F.contains(p, F.lit("=")), _decoded(F.regexp_replace(p, "^[^=]*=", ""))).otherwise(F.lit("")).alias("v")))
    return F.array_sort(pairs)


def _netloc(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(c, r"^[^:/?#]*://([^/?#]*)", 1)), r"^www\.", "")


def _inner_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)


def metric_key(c: Column) -> Column:
    """The key by which addresses are compared with truth; `no_existe`, blank and null give the empty string.

    Scheme, one leading www., fragment, trailing slashes and the order of parameters don't matter;
    parameters are decoded and sorted, then their names lower-cased. The path's case matters.
    """
    x = F.trim(F.coalesce(c, F.lit("")))
    x = F.when(F.contains(x, F.lit("://")), x).otherwise(F.concat(F.lit("http://"), x))
    query = F.array_join(F.transform(_pairs(F.regexp_extract(x, r"\?([^#]*)", 1)), lambda p: F.concat(F.lower(p["k"]), F.lit("="), p["v"])), "&")
    base = F.concat(_netloc(x), F.regexp_replace(_inner_path(x), "/+$", ""))
    none = F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("", "no_existe")
    return F.when(none, "").otherwise(F.concat(base, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def key_host(key: Column) -> Column:
    """The host of a metric key."""
    return F.substring_index(F.substring_index(key, "?", 1), "/", 1)


def reach_key(c: Column, drop_defaults: bool = False) -> Column:
    """(host, path, parameters) by which a link proves that a page is reached; parameters that mean all years can be dropped."""
    x = clean_url(c)
    pairs = _pairs(F.regexp_extract(x, r"\?([^#]*)", 1))
    if drop_defaults:
        pairs = F.filter(pairs, lambda p: ~(F.lower(p["k"]).isin("ano", "year") & p["v"].isin("", "0", "todos", "todas")))
    path_ = F.regexp_replace(_inner_path(x), "/+$", "")
    return F.struct(_netloc(x).alias("host"), F.when(path_ == "", "/").otherwise(path_).alias("path"), pairs.alias("query"))


def same_page(a: Column, b: Column) -> Column:
    """Whether two addresses reach the same page, parameters that mean all years apart."""
    return (reach_key(a) == reach_key(b)) | (reach_key(a, True) == reach_key(b, True))


def bounded_url(c: Column, limit: int = 180) -> Column:
    """An address longer than `limit` with only the last 80 characters of its path."""
    head, rest = F.regexp_extract(c, r"^([^:/?#]*://[^/?#]*)", 1), F.regexp_extract(c, r"([?#].*)$", 1)
    return F.when(F.length(c) > limit, F.concat(head, F.lit("/..."), F.right(_inner_path(c), F.lit(80)), rest)).otherwise(c)


def host_base(c: Column) -> Column:
    """Scheme and host; empty if one of them is missing."""
    return F.coalesce(F.regexp_extract(c, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+)", 1), F.lit(""))


def document_url(c: Column) -> Column:
    """Whether an address is that of a document, or hands one to a viewer."""
    low = _decoded(F.lower(F.coalesce(c, F.lit(""))))
    return F.substring_index(low, "?", 1).rlike(r"\.(pdf|doc|docx)$") | (low.rlike(r"\.(pdf|doc)") & low.rlike("file=|pdf=|arquivo="))


def unwrapped(c: Column) -> Column:
    """The document that a viewer's address names in file, pdf or arquivo; other addresses stay."""
    inner = F.lit(None).cast("string")
    for k in ("arquivo", "pdf", "file"):
        v = _decoded(_decoded(F.regexp_extract(c, rf"[?&]{k}=([^&#]*)", 1)))
        inner = F.when(F.lower(v).startswith("http") & document_url(v), v).otherwise(inner)
    return F.coalesce(inner, c)


#: Pages of one item, whatever they say (fixed patterns); and addresses that can be either (fixed pattern).
HARD_DETAIL = (r"/id/[0-9]+", "/detalhe/", "/legislacao/detalhe", "[?&]slug=", r"\.pdf(\?|$)")
MAYBE_DETAIL = (r"/conteudos?/[0-9]+",)


def hard_detail(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).rlike("|".join(HARD_DETAIL))


def maybe_detail(c: Column) -> Column:
    """Pages of one item, and those that may be one."""
    return F.lower(F.coalesce(c, F.lit(""))).rlike("|".join(HARD_DETAIL + MAYBE_DETAIL))


#: Parts of hosts that are never an official site (fixed values).
NEVER_OFFICIAL = ("facebook.", "instagram.", "youtube.", "twitter.", "x.com", "linkedin.", "acheconcursos.", "pciconcursos.", "qconcursos.", "google.", "bing.", "duckduckgo.")


def listed_host(c: Column) -> Column:
    """Whether a host is one of those that are never official."""
    h = host(c)
    out = F.lit(False)
    for p in NEVER_OFFICIAL:
        out = out | F.contains(h, F.lit(p))
    return out


def freeze_group(c: Column, shared: tuple[str, ...] = ()) -> Column:
    """The group that a freeze stops: the /24 net of an IPv4 host, else the host; hosts of shared providers stand alone."""
    h = F.regexp_replace(host(c), r":[0-9]+$", "")
    net = F.concat(F.lit("ipv4:"), F.substring_index(h, ".", 3), F.lit(".0/24"))
    return F.when(h.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), net).otherwise(F.concat(F.lit("host:"), h))


#: Where each provider's links to one announcement lie (fixed patterns): name, pattern on the whole address.
PROVIDERS = (
    ("legalle", r"/edital/ver/[0-9]+"),
    ("fundatec", r"[?&]concurso=[0-9]+"),
    ("lasalle", r"(?i)^https?://(?:www\.)?fundacaolasalle\.org\.br/concurso/[^/?#]+/?(?:[?#]|$)"),
    ("selecao", r"(?i)\.selecao\.net\.br/informacoes/[0-9]+/?"),
    ("quadrix", r"(?i)quadrix\.org\.br/informacoes/[0-9]+/?"),
    ("objetiva", r"(?i)concursos\.objetivas\.com\.br/informacoes/[0-9]+/?"),
    ("cebraspe", r"(?i)cebraspe\.org\.br/concursos/[A-Z0-9_]+/?"),
    ("consulplan", r"(?i)^https?://[^/?#]*institutoconsulplan\.org\.br/Concurso/[^/?#]+/?(?:[?#]|$)"),
    ("fgv", r"^https?://[^/?#]*(?i:conhecimento\.fgv\.br)/+concursos/(?!nosso-portfolio/*(?:[?#]|$))[^/?#]+/*(?:[?#]|$)"),
    ("cesgranrio", r"^https?://[^/?#]*(?i:cesgranrio\.org\.br)/concurso/[^/?#]+/?(?:[?#]|$)"),
    ("faurgs", r"(?i)^https?://[^/?#]*portalfaurgs\.com\.br/concursosFaurgs/(?:emandamento|encerrados)/[^/?#]+/?(?:[?#]|$)"),
    ("fcc", r"(?i)^https?://[^/?#]*concursosfcc\.com\.br/concursos/[^/?#]+/index\.html(?:[?#]|$)"),
    ("aocp", r"(?i)^https?://[^/?#]*institutoaocp\.org\.br/concursos/[0-9]+/?(?:[?#]|$)"),
    ("ibfc", r"^https?://[^/?#]*(?i:ibfc\.org\.br)/informacoes/[0-9]+/?(?:[?#]|$)"),
)


def provider_detail(c: Column, provider: str) -> Column:
    """Whether a link leads to one announcement of a provider."""
    return F.coalesce(c.rlike(dict(PROVIDERS)[provider]), F.lit(False))


def provider_of(c: Column) -> Column:
    """The first provider whose pattern a link meets; empty if none."""
    out = F.lit("")
    for name, _ in reversed(PROVIDERS):
        out = F.when(provider_detail(c, name), name).otherwise(out)
    return out


def provider_page(c: Column) -> Column:
    """The page of an announcement under one fixed address where the provider names it by a parameter; others stay."""
    n = F.regexp_extract(c, r"concurso=([0-9]+)", 1)
    return F.when(provider_detail(c, "fundatec"), F.concat(F.lit("https://www.fundatec.org.br/portal/concursos/pagina_editais.php?concurso="), n)).otherwise(c)
