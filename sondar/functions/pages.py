"""Predicates on pages and addresses (fixed word lists; parameters of the rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sondar.functions import text as T
from sondar.functions import urls as U

#: Fixed values, each list that of one predicate.
SOFT_404 = ("pagina nao encontrada", "nao encontramos", "erro 404", "error 404", "not found", "pagina inexistente", "conteudo nao encontrado")
NOT_FOUND = ("pagina nao encontrada", "page not found", "404 not found", "erro 404", "conteudo nao encontrado")
PARKED = ("em construcao", "site em construcao", "pagina em construcao", "em manutencao", "site em manutencao", "hospedagem de site", "dominio gratis", "registre seu dominio", "compre este dominio", "domain for sale", "this domain is for sale")
CHALLENGE = ("security checkpoint", "vercel security", "just a moment", "checking your browser", "attention required", "cloudflare", "verifying you are human", "enable javascript and cookies")
AUDIT_CHALLENGE = ("um momento", "just a moment", "verificacao de seguranca", "verificando seguranca", "checking your browser", "cf browser verification", "attention required", "enable javascript and cookies to continue", "ddos guard", "needs to review the security")
HARD_MARKS = ("challenge-platform", "/cdn-cgi/challenge", "_cf_chl_opt", "cf_chl_", "ddos-guard")
CHALLENGE_TITLES = ("one moment, please", "just a moment", "checking your browser", "attention required")
SERVER_ERROR = ("server error in", "runtime error", "application error", "erro de execucao", "internal server error", "http error 500", "service unavailable", "error 503", "nao foi possivel conectar-se ao banco", "could not connect", "error establishing a database", "whoops, something went wrong", "exception details")
WALL = ("usa cookies", "utiliza cookies", "aceitar cookies", "aceite os cookies", "faca seu login", "habilite o javascript", "enable javascript", "ative o javascript", "ativar o javascript")
BLOCKED = ("wordfence", "acesso a este site foi limitado", "maximum number of page requests", "page requests per minute")
DEFINED = ("e um processo seletivo", "e o procedimento", "tem por objetivo selecionar", "destina se a selecionar", "e uma forma de")
NO_EVENTS = ("nenhum registro encontrado", "nao ha certames", "sem editais publicados", "nenhum resultado")
FRAMEWORK = ("__next_data__", "/_next/", "window.__nuxt__", "data-reactroot", 'id="__nuxt"')
LANDING = ("", "web", "home", "inicio", "index.php", "index.html", "portal", "site")
FILES = ("pdf", "doc", "docx", "xls", "xlsx")
#: Concrete entries of a listing (fixed patterns).
ENTRY = (r"(?<![0-9.])[0-9]{1,3}\s*[/\-]\s*20[12][0-9]\b", r"(?i)edital\s+n|inscri[cç][oõ]es\s+(aberta|encerrada)|resultado\s+(final|parcial|preliminar)|homologa[cç][aã]o|retifica[cç][aã]o", r"(?i)(concurso|processo\s+seletivo|sele[çc]\w+\s+p\w+)[^\n]{0,15}?\b20[12][0-9]\b")
KEYWORDS = ("concurso", "seletivo", "selecoes", "edital", "pss")


def ok(status: Column, error: Column | None = None) -> Column:
    """No error and no status, or one from 200 to 399."""
    good = status.isNull() | status.between(200, 399)
    return good if error is None else good & error.isNull()


def head(c: Column, n: int) -> Column:
    return T.fold(F.substring(F.coalesce(c, F.lit("")), 1, n))


def soft404(status: Column, folded: Column) -> Column:
    """Not ok, or a phrase in the folded title and first 500 characters."""
    return ~ok(status) | T.holds(folded, SOFT_404)


def title_and_head(title: Column, content: Column, n: int) -> Column:
    """fold of the title and the first n characters."""
    return T.fold(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(F.coalesce(content, F.lit("")), 1, n)))


def challenged(title: Column, content: Column, html: Column) -> Column:
    """A checkpoint's signature anywhere in title, text or source, all in lower case."""
    out = F.lit(False)
    for c in (title, content, html):
        out = out | T.holds(c, CHALLENGE)
    return out


def guarded(title: Column, content: Column, html: Column) -> Column:
    """A checkpoint's mark in the source, or its title over a text of under 1500 characters; title and source in lower case."""
    thin = F.length(F.coalesce(content, F.lit(""))) < 1500
    return T.holds(F.substring(html, 1, 200000), HARD_MARKS) | (T.holds(title, CHALLENGE_TITLES) & thin)


def walled(content: Column, folded: Column, items: Column) -> Column:
    """A text of at most 2500 characters and fewer than two items that asks for cookies, a login or scripts."""
    return (F.length(F.coalesce(content, F.lit(""))) <= 2500) & (items < 2) & T.contains_any(folded, WALL)


def blocked(status: Column, html: Column) -> Column:
    """A status of too many requests or overload, or a blocker's phrase in the first 5000 characters of the source."""
    head = F.substring(html, 1, 5000)
    # each phrase has one of these words, so most sources needn't be folded
    said = F.when(head.rlike("(?i)wordfence|limitado|requests"), T.contains_any(T.fold(head), BLOCKED))
    return F.coalesce(status.isin(429, 503), F.lit(False)) | F.coalesce(said, F.lit(False))


def has_entry(content: Column) -> Column:
    """Whether a text has at least one concrete entry of a listing."""
    c, out = F.coalesce(content, F.lit("")), F.lit(False)
    for p in ENTRY:
        out = out | c.rlike(p)
    return out


def thin_shell(status: Column, content: Column, html: Column) -> Column:
    """A page that is ok, of at least 2000 characters of source with a script of its own, and under 500 of text."""
    long, short = F.length(F.coalesce(html, F.lit(""))) >= 2000, F.length(F.trim(F.coalesce(content, F.lit("")))) < 500
    return ok(status) & long & short & F.coalesce(html.rlike(r"(?i)<script[^>]+\bsrc\s*="), F.lit(False))


def app_shell(html: Column, links: Column) -> Column:
    """A framework's mark in the source and fewer than eight links with a scheme."""
    return T.contains_any(F.lower(F.substring(html, 1, 200000)), FRAMEWORK) & (links < 8)


def no_events(content: Column) -> Column:
    """A statement that there are none, in lower case with or without accents."""
    return T.contains_any(F.translate(F.lower(content), "ãáâéêíóôõúç", "aaaeeiooouc"), NO_EVENTS)


def complete(content: Column) -> Column:
    """Not blank and at least three line feeds."""
    c = F.coalesce(content, F.lit(""))
    return (F.trim(c) != "") & (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) >= 3)


def landing(url: Column) -> Column:
    return F.lower(F.regexp_replace(U.path(U.clean_url(url)), "^/+|/+$", "")).isin(*LANDING)


def file_url(url: Column) -> Column:
    return F.lower(U.path(url)).rlike(r"\.(" + "|".join(FILES) + ")$")


def keyword_url(url: Column) -> Column:
    return T.contains_any(F.lower(U.path(url)), KEYWORDS)


def url_year(url: Column) -> Column:
    """The year named in an address; null if there is none."""
    y = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?:ano|year)=((?:19|20)[0-9]{2})", 1)
    return F.when(y != "", y.cast("int"))
