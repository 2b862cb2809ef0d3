"""Template residue and error pages, found by labelled exemplars.

Exemplars are short passages labelled by what they are: unfilled placeholders and filler (a
case wherever they stand), error, block, maintenance and script messages (a case where
nothing else is left of the page), and genuine notices that read alike. An inverted index
over their terms retrieves the exemplars that speak about a passage; the TF-IDF weight of the
passage's terms that those hold, over the weight of all its terms, is its containment.
Passages are windows of lines and sentences. A bracketed or masked run is a passage of its
own, with its marks as terms, so that placeholders go through the same index.

Weights come from counts over all pages. Of a message's terms that no exemplar has, those
count in full that real text is known to use; a word that is strange to all long bodies of
the corpus says little. So messages in other words than the exemplars' are found as well.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.llm.pages import LineModel, content_lines, heading_line, labelled_pages, line_words, train
from sondar.plans.lineage import written

#: Labelled exemplars (fixed values). Figures stand for any figures.
EXEMPLARS: dict[str, str] = {
    "error": """
A página que você procura não existe ou foi removida
Página não encontrada
Ops! Não localizamos o endereço solicitado. Verifique o link e tente de novo
O documento pedido não está mais disponível
A publicação solicitada foi movida ou excluída
O endereço informado foi movido ou excluído
Este conteúdo saiu do ar
Este conteúdo retornou uma falha
O serviço consultado excedeu o tempo de resposta
A rota acessada não pôde ser carregada
O documento não pôde ser carregado
O arquivo solicitado não foi localizado
O item 0 não existe mais ou foi despublicado
Registro inexistente
Ocorreu um erro inesperado no servidor
Erro interno do servidor
Erro 0
Algo deu errado
Falha
Ops
Oops
Atenção
Aviso
Indisponível
Não foi possível conectar ao banco de dados
Não foi possível processar a sua solicitação
O servidor de origem não respondeu a tempo
SQLSTATE[HY0] [0] Connection refused
Fatal error: Uncaught exception 'PDOException' in /srv/app/lista.php:0
Stack trace: #0 {main}
Warning: Undefined variable in /var/www/html/index.php on line 0
Server Error in '/' Application
Object reference not set to an instance of an object
java.lang.NullPointerException at org.apache
Not Found
The requested URL was not found on this server
The page you are looking for could not be found
The page has been removed
Gone
Bad Gateway
Gateway Timeout
Internal Server Error
Service Unavailable
Unavailable
Error
The upstream service timed out
This resource is temporarily offline
The record you asked for could not be loaded
No server is available to handle this request
The server encountered an internal error and was unable to complete your request
Please try again later
Tente mais tarde
Tente novamente em alguns minutos
Volte à página anterior
Voltar à página inicial
Verifique o endereço digitado
Se o problema continuar, avise o suporte
Se o problema persistir, entre em contato com o administrador
Chamado 0
Código de referência: a0
Trace a0
Ray a0
ID do evento: 0
Protocolo do erro: 0
El recurso solicitado no está disponible
El documento ya no existe
La dirección no se pudo abrir
La sección pedida está fuera de servicio
La página no existe
Lo sentimos
Fallo
Error interno
Vuelva a intentarlo
Intente más tarde
Sorry, something went wrong on our end
This site can't be reached. The connection was refused or has timed out
An error occurred while processing your request
Oops! That page can't be found
Error establishing a database connection
O link que você seguiu pode estar quebrado ou expirado
Tempo limite da conexão esgotado
Estamos enfrentando problemas técnicos; desculpe o transtorno
Serviço em atualização; retorne mais tarde
Lo sentimos, algo salió mal
Se produjo un error inesperado al procesar su solicitud
""",
    "block": """
Acesso negado
Você não tem permissão para acessar este recurso
Só pode ser visto por usuários autorizados
Forbidden
This resource requires authorization
Access denied
Your IP has been blocked. Incident 0
Exige permisos
No tiene permiso para ver esta página
Acceso denegado
Limite de acessos atingido. Aguarde 0 segundos
Muitas requisições
Too many requests
Confirme que você é uma pessoa
Verificando se a conexão é segura
Verificação
Estamos conferindo o seu navegador; aguarde 0 segundos
Este processo é automático; libere cookies e scripts
Checking your browser before you proceed. This takes about 0 seconds
Checking
Attention required
Please verify you are a human
Estamos comprobando su navegador
Sorry, you have been blocked
Complete the captcha to prove that you are not a robot
Requests from your network are blocked by a security policy
Pedido bloqueado pelo firewall por atividade suspeita
Prove que você não é um robô
Su dirección fue bloqueada; demuestre que no es un robot
""",
    "maintenance": """
Sistema temporariamente indisponível
Em manutenção
Site em manutenção. Retornaremos em 0 minutos
Estamos em manutenção. Voltaremos em breve
Portal em construção
Under maintenance. We will be back soon
Sitio en mantenimiento. Volveremos pronto
Esta conta de hospedagem está suspensa. Contate o administrador
Domínio suspenso
This account has been suspended
Cuenta suspendida
Site fora do ar para manutenção programada
Estamos melhorando o portal; voltamos logo
Down for scheduled maintenance; check back soon
Domínio expirado; contate o provedor e renove o registro
This domain has expired; contact your provider
""",
    "session": """
Sessão expirada
Sua sessão expirou por inatividade. Faça login novamente
Your session has expired. Please log in again
Su sesión ha caducado. Inicie sesión de nuevo
Token inválido ou expirado; autentique-se novamente
Session timed out; sign in again
""",
    "loading": """
Carregando
Carregando dados
Carregando, aguarde um instante
Aguarde
Loading, please wait
Cargando datos
Processando, por favor espere
Redirecionando em alguns segundos
Redirecting in a moment
Espere un momento
""",
    "scripts": """
Você precisa habilitar o JavaScript para executar este aplicativo
Seu navegador não suporta JavaScript ou ele está desligado. O conteúdo não pode ser exibido
Por favor, ative os scripts do seu navegador e recarregue a página
Navegador incompatível: atualize-o ou habilite recursos de script para ver a lista
Habilite o motor de scripts do navegador e atualize a página
É necessário autorizar a execução de scripts para que os dados apareçam
Ligue scripts e cookies para ver esta lista
Permita JavaScript para abrir o portal
Permita scripts e cookies para continuar
You need to enable JavaScript to run this app
Please turn on cookies and scripts to view this page
Please turn on JavaScript to load the list
Please turn on scripts to continue
Esta aplicación requiere JavaScript para mostrar los datos
Active los scripts en su navegador para seguir
Active JavaScript en su navegador para ver el listado
O navegador precisa ter JavaScript ativado e atualizado
This site requires JavaScript; enable it in your browser settings
JavaScript está desactivado; habilite los scripts y las cookies para continuar
App
Portal
Sistema
Transparência
""",
    "filler": """
Insira aqui o texto principal deste bloco
Escreva aqui o conteúdo da página e depois publique
Digite aqui o título e o conteúdo da página
Digite aqui o conteúdo da página
Substitua este texto pelo conteúdo definitivo
Edite este bloco de texto antes de publicar a página
Clique aqui para editar este parágrafo
Clique para adicionar título ou texto
Este é um texto de exemplo que deve ser substituído
Este é um parágrafo de exemplo; apague-o e escreva o seu
Texto provisório apenas para preencher espaço
Página de teste criada automaticamente; pode ser apagada
Modelo de página: troque este texto pelo seu
Sample page: replace this text with your own content
This is sample text; replace it with your own words
Click here to edit this paragraph
Your text here
This is an example page; edit or delete it
Placeholder copy to be replaced before publishing
Escriba aquí el contenido de la página
Reemplace este texto por el contenido definitivo
Haga clic aquí para editar este bloque
Este es un texto de ejemplo; bórrelo y escriba el suyo
Texto de exemplo
Imagem ilustrativa: troque pela foto real
Conteúdo em elaboração; substitua antes de publicar
Este conteúdo é apenas um modelo e será substituído
Adicione aqui uma descrição, um subtítulo e uma legenda
Descreva aqui o serviço, a seção ou a notícia
Apague este parágrafo e comece a escrever
Texto fictício para demonstração do leiaute
Título da página aqui
Nova página
Título da seção
Subtítulo da seção
Página sem título
Sample text
Untitled document
Click to add title
Dummy text for layout demonstration only
Texto provisional, sustituir antes de publicar
Texto de prueba
Nueva página
New page
Section title
Hello world
Write something here, then save and publish
""",
    "nonsense": """
Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur
Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum
asdf asdf asdfg qwerty qwertyuiop blabla
""",
    "placeholder": """
{{nome}} {% if item %} <% titulo %> ${titulo} #{titulo} [[titulo]] <<NOME>> %(nome)s ##NOME## @@NOME@@ __NOME__ %NOME% {nome} {0}
[NOME DO CANDIDATO] [NOME DO MUNICÍPIO] [NÚMERO DO EDITAL] [DATA] [CARGO] [TÍTULO DA PÁGINA] [TEXTO AQUI] [VALOR] [LOCAL] [ENDEREÇO] [E-MAIL] [TELEFONE]
[INSERIR TEXTO] [inserir o texto aqui] [INSERIR DATA] [PREENCHER] [preencher o campo] [COMPLETAR] [INSERTAR TEXTO] [INSERT TEXT HERE] [YOUR NAME] [NAME] [DATE] [TITLE] [object Object]
<NOME> <DATA> <CARGO> <TÍTULO> <MUNICÍPIO> <inserir texto> <preencher> <insert text> <NAME> <DATE> <FECHA> <NOMBRE>
(preencher) (preencher com o nome) (preencher o número e a data) (a preencher) (inserir texto) (inserir aqui o link) (informar o valor) (completar) (completar el dato) (rellenar) (insert text here) (insertar el nombre)
:nome: :data: :titulo: :numero: :name: :date: :title:
XX/XX/XXXX xxxxx X.XXX,XX TODO: FIXME:
""",
    "genuine": """
Não há certames abertos no momento
Não há concursos em andamento
Nenhum registro encontrado para 0
Sem editais publicados neste ano
O próximo edital será divulgado em 0 de janeiro de 0
Não há editais publicados
No hay concursos abiertos
Nenhum resultado encontrado
O portal ficará em manutenção no dia 0/0/0, das 0h às 0h, sem prejuízo das inscrições
Por instabilidade, o sistema exibiu página não encontrada em 0/0/0; o prazo foi prorrogado
O que fazer se a página não for encontrada?
Preciso aceitar cookies para me inscrever?
Preencha à mão: Nome ____ Inscrição ____
""",
}
#: Labels of exemplars that make a page a case where nothing else is left of it.
MESSAGES = tuple(x for x in EXEMPLARS if x not in ("filler", "nonsense", "placeholder", "genuine"))
#: A passage counts as residue from this containment on, on a page that has no other text at all from the lower one.
CONTAINED, BARE = 0.78, 0.55
#: Passages are looked at in windows of so many terms; filler in narrower ones, of at least so many terms.
WINDOW, FILL_WINDOW, FILL_LEAST, FEW = 40, 12, 4, 6
#: Weight of a term that no page has; of one that only residue or rare text has; least weight of a rare filler term.
UNSEEN, STRANGE, RARE = 4.6, 0.7, 3.0
#: A term is typical of real text if more than this share of pages with a long body have it there.
TYPICAL, LONG, BUCKETS = 2e-4, 6, 1 << 20
#: An exemplar is asked about a passage if the passage has this share of its weight.
SPEAKS = 0.15
STEM = 5
#: So many lines of a message are judged together.
FEW_LINES = 4

_FIGURE = re.compile(r"\b(?=\w*\d)\w+\b")
_TOKEN = re.compile(rb"[a-z\x80-\xff]+")
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+")
_OTHER = re.compile(r"[^\x00-\x7e]+")
#: Pairs of marks that a template engine writes around a name (fixed values).
_CODE = (("{{", "}}"), ("{%", "%}"), ("<%", "%>"), ("${", "}"), ("#{", "}"), ("[[", "]]"), ("<<", ">>"), ("%(", ")s"), ("##", "##"), ("@@", "@@"), ("__", "__"), ("%", "%"), ("{", "}"))
#: Pairs of marks that ordinary text has, too: what stands between them decides.
_SOFT = (("[", "]"), ("<", ">"), ("(", ")"), (":", ":"))
_MASK = re.compile(r"(?<!\w)(?:[Xx]{2,}(?:(?:/|\s+de\s+)(?:20)?[Xx]{2,})+|[Xx]{5,}|[Xx]+(?:\.[Xx]{3})*,[Xx]{2})(?!\w)|\b(?:TODO|FIXME):")
_NAME = re.compile(r"[=\-#&/!*\s]*[^\W\d][\w.|:\- ]*|\d+")


def _run_pattern() -> re.Pattern:
    """One pattern for all runs; it begins with a class of characters, which a search passes over quickly."""
    rest: dict[str, list[str]] = defaultdict(list)
    for a, b in _CODE + _SOFT[:2]:
        shut, first = re.escape(b[0]), re.escape(a[0])
        before, after = f"(?<={first})", ""
        if a in ("##", "@@"):
            inner = r"\s?[^\W\d]\w*\s?"
        elif a == "__":
            before, inner, after = rf"(?<=_)(?<!\w_)", r"[^\W\d_](?:\w*[^\W_])?", r"(?!\w)"
        elif a == "%":
            before, inner, after = rf"(?<=%)(?<![\w%]%)", r"[^\W\d_]+(?:_\w+)*", r"(?![\w%])"
        elif a in ("{", "<", "["):
            inner = r"[^\[\]<>(){}\n]+"
        else:
            inner = rf"[^{re.escape(a[-1])}{shut}\n]+"
        rest[a[0]].append(before + re.escape(a[1:]) + inner + re.escape(b) + after)
    marks = "".join(re.escape(c) for c in rest)
    return re.compile(f"[{marks}](?:" + "|".join("|".join(x) for x in rest.values()) + ")")


_RUN = _run_pattern()
#: Runs between marks that are everywhere in ordinary text have patterns of their own, which begin with a literal.
_OFTEN = (("(", re.compile(r"\([^\[\]<>(){}\n]+\)")), (":", re.compile(r":(?<![\w:/]:)[^\W\d]\w*:(?![\w/])")))


def stems(text: str) -> list[str]:
    """Terms of a passage: words cut to STEM letters, figures masked; a mix of letters and figures counts as a figure."""
    return [w[:STEM] for w in line_words(_FIGURE.sub("0", text)) if w.isalnum() or w == "0"]


_STEMS: dict[bytes, str] = {}


def tokens(text: str) -> set[bytes]:
    """The distinct words of a text, as bytes; beyond ASCII all bytes are alike."""
    return set(_TOKEN.findall(text.lower().encode("utf-8", "surrogatepass")))


def stem_of(token: bytes) -> str:
    """The term of a token."""
    got = _STEMS.get(token)
    if got is None:
        if len(_STEMS) > 500_000:
            _STEMS.clear()
        got = _STEMS[token] = _OTHER.sub("ç", token.decode("utf-8", "replace"))[:STEM]
    return got


def _inner(text: str) -> list[str]:
    return ["FIGURE" if t == "0" else t for t in stems(text)]


def runs(text: str) -> Iterator[str]:
    """The bracketed and masked runs of a text."""
    if "&lt;" in text:
        text = text.replace("&lt;", "<").replace("&gt;", ">")
    if any(c in text for c in "{<[%@#_$"):
        for m in _RUN.finditer(text):
            yield m.group()
    for mark, pattern in _OFTEN:
        if mark in text:
            yield from pattern.findall(text)
    if "x" in text or "X" in text or "TODO:" in text or "FIXME:" in text:
        for m in _MASK.finditer(text):
            yield m.group()


@lru_cache(maxsize=100_000)
def shape(run: str) -> tuple[str, ...]:
    """The terms of a bracketed or masked run: its marks, and what stands between them.

    Between marks of a template engine any name is one and the same term; between marks that
    ordinary text has, too, the words are kept, with a term for capitals.
    """
    for a, b in _CODE:
        if run.startswith(a) and run.endswith(b) and len(run) >= len(a) + len(b):
            inner = run[len(a) : len(run) - len(b)].strip()
            return (f"{a} {b}", "NAME") if _NAME.fullmatch(inner) else (f"{a} {b}", *_inner(inner))
    if (run[0], run[-1]) in _SOFT:
        ts = _inner(run[1:-1])
        return (f"{run[0]} {run[-1]}", *(["CAPS"] if run[1:-1].isupper() else []), *ts) if ts else ()
    return ("mask todo" if run.endswith(":") else "mask x",)


def shapes(text: str) -> Iterator[tuple[str, ...]]:
    """The terms of each bracketed or masked run of a text."""
    for run in runs(text):
        ts = shape(run) if len(run) < 200 else shape.__wrapped__(run)
        if ts:
            yield ts


@lru_cache(maxsize=1)
def index() -> tuple[list[tuple[str, frozenset]], dict[str, list[int]]]:
    """Exemplars (label, terms) and the inverted index term -> exemplars."""
    ex = []
    for label, block in EXEMPLARS.items():
        for line in block.strip().split("\n"):
            for ts in shapes(line) if label == "placeholder" else [stems(line)]:
                ex.append((label, frozenset(ts)))
    post = defaultdict(list)
    for i, (_, ts) in enumerate(ex):
        for t in ts:
            post[t].append(i)
    return ex, dict(post)


@lru_cache(maxsize=1)
def _filler() -> tuple[list[frozenset], list[str]]:
    lines = EXEMPLARS["filler"].strip().split("\n")
    return [frozenset(stems(x)) for x in lines], lines


@lru_cache(maxsize=1)
def _nonsense() -> frozenset:
    return frozenset(t for t in stems(EXEMPLARS["nonsense"]) if len(t) > 3)


def bucket(term: str) -> int:
    """The bucket that a term's count goes to; the same in every worker."""
    return crc32(term.encode()) & (BUCKETS - 1)


class Residue:
    """Containment of passages in the exemplars, under term weights learned from all pages."""

    def __init__(self, idf: dict[str, float], typical: dict[int, float] = {}):
        self.idf, self.typical = idf, typical
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[str, tuple[float, str]] = {}
        self._rare: frozenset | None = None
        self._known: dict[str, tuple[float, float]] = {}
        self._short: tuple[frozenset, frozenset, frozenset] | None = None
        self._weights: list[float] | None = None
        self._unfilled: dict[tuple[str, ...], bool] = {}
        self._flags: dict[bytes, int] = {}

    def __getstate__(self):
        return self.idf, self.typical

    def __setstate__(self, state):
        self.idf, self.typical = state
        self._reset()

    def against(self, term: str, lenient: bool) -> float:
        """Weight of a term that speaks against containment."""
        got = self._known.get(term)
        if got is None:
            if len(self._known) > 200_000:
                self._known.clear()
            rare = self.typical.get(bucket(term), 0.0)
            # a term that real text hardly uses says little; one that all text uses, too
            got = self._known[term] = min(rare, STRANGE - math.log(TYPICAL) - rare) if rare else STRANGE, self.idf.get(term, rare or UNSEEN)
        return got[0] if lenient and self.typical else got[1]

    def passage(self, text: str) -> tuple[float, str]:
        """(containment, label) of a line: its least contained window."""
        if text in self.memo:
            return self.memo[text]
        ts = stems(text)
        if not ts or set(ts) == {"0"}:
            return 1.0, "blank"
        most = self.most(ts)
        worst = (most, "none") if most < BARE else (2.0, "")
        for a in range(0, max(1, len(ts) - WINDOW // 2), WINDOW // 2) if most >= BARE else ():
            worst = min(worst, self._window(ts[a : a + WINDOW], MESSAGES, True))
        if len(self.memo) > 100_000:
            self.memo.clear()
        if len(text) <= 400:  # long ones hardly come again
            self.memo[text] = worst
        return worst

    def most(self, ts: list[str]) -> float:
        """What containment in messages can reach at most: no term that no exemplar has is held."""
        post = index()[1]
        r = g = 0.0
        for t in ts:
            if t in post:
                r += self.idf.get(t, UNSEEN)
            else:
                g += self.against(t, True)
        return r / (r + g) if r else 0.0

    def weight(self, i: int) -> float:
        """An exemplar's whole weight."""
        if self._weights is None:
            self._weights = [sum(self.idf.get(t, UNSEEN) for t in ts) for _, ts in index()[0]]
        return self._weights[i]

    def placeholder(self, text: str) -> bool:
        """Whether some bracketed or masked run of the text is contained in placeholder exemplars."""
        for ts in shapes(text):
            got = self._unfilled.get(ts)
            if got is None:
                if len(self._unfilled) > 100_000:
                    self._unfilled.clear()
                got = self._unfilled[ts] = self._window(list(ts), ("placeholder",), False)[0] >= CONTAINED
            if got:
                return True
        return False

    def rare(self) -> frozenset:
        """Terms of filler exemplars that few pages have."""
        if self._rare is None:
            self._rare = frozenset(t for label, ts in index()[0] if label in ("filler", "nonsense") for t in ts if t != "0" and self.idf.get(t, UNSEEN) >= RARE)
        return self._rare

    def _few(self) -> tuple[frozenset, frozenset, frozenset]:
        """Term sets of filler exemplars too short for a window, how they begin, and the rarest term of each: only a whole line of them is filler."""
        if self._short is None:
            few = [(ts, line) for ts, line in zip(*_filler()) if len(ts) <= FEW]
            rarest = frozenset(max(ts, key=lambda t: (self.idf.get(t, UNSEEN), t)) for ts, _ in few if ts)
            self._short = frozenset(ts for ts, _ in few), frozenset(line[:3].lower() for _, line in few), rarest
        return self._short

    def filler(self, text: str) -> bool:
        """Whether some window of a line or sentence of the text is contained in filler exemplars, or a short line is one.

        Two nonsense words side by side are enough.
        """
        few, begin, rarest = self._few()
        rare = self.rare()
        hints, flags = 0, self._flags
        for t in tokens(text):
            f = flags.get(t)
            if f is None:
                if len(flags) > 500_000:
                    flags.clear()
                w = stem_of(t)
                f = flags[t] = (w in rare) | (w in rarest) << 1
            hints |= f
        if not hints:
            return False
        lines = text.split("\n")
        if hints & 2:
            for line in lines:
                if line.lstrip()[:3].lower() in begin and frozenset(stems(line)) in few:
                    return True
        if not hints & 1:
            return False
        nonsense = _nonsense()
        for line in lines:
            if len(rare.intersection(map(stem_of, tokens(line)))) < 2:
                continue
            for part in dict.fromkeys((line, *_SENTENCE.split(line))):
                ts = stems(part)
                if len(rare.intersection(ts)) < 2:
                    continue
                if any(x in nonsense and y in nonsense and x in rare and y in rare for x, y in zip(ts, ts[1:])):
                    return True
                for a in range(0, max(1, len(ts) - FILL_WINDOW // 2), FILL_WINDOW // 2):
                    w = ts[a : a + FILL_WINDOW]
                    if len(w) >= FILL_LEAST and len(rare.intersection(w)) >= 2 and self._window(w, ("filler", "nonsense"), False)[0] >= CONTAINED:
                        return True
        return False

    def _window(self, ts: list[str], labels: tuple[str, ...], lenient: bool) -> tuple[float, str]:
        """(containment in exemplars of these labels, the nearest one's label) of terms.

        A term counts once, or, if lenient, as often as it stands. Terms that no exemplar has speak against it: with their full weight, or, if lenient, only
        where real text is known to use them.
        """
        ex, post = index()
        own = Counter(ts if lenient else set(ts))
        score: Counter = Counter()
        for t in own:
            for i in post.get(t, ()):
                score[i] += self.idf.get(t, UNSEEN)
        if not score:
            return 0.0, "none"

        def held(ids) -> float:
            has = frozenset().union(*(ex[i][1] for i in ids)) if ids else frozenset()
            r = g = 0.0
            for t, c in own.items():
                if t in has:
                    r += self.idf.get(t, UNSEEN) * c
                else:
                    g += c * self.against(t, lenient)
            return r / (r + g) if r else 0.0

        near = sorted((i for i in score if score[i] >= SPEAKS * self.weight(i)), key=lambda i: (-score[i] / (1 + self.weight(i) ** 0.5), i))
        residue = [i for i in near if ex[i][0] in labels]
        # a genuine notice speaks only if the passage has most of it, too
        genuine = [i for i in near if ex[i][0] == "genuine" and score[i] >= 0.6 * self.weight(i)][:1]
        r, g = held(residue), held(genuine)
        label = ex[residue[0]][0] if residue else "genuine"
        return (r, label) if r > g + 1e-9 else (0.0, "genuine")


def learn_weights(labelled: DataFrame, content: str) -> Residue:
    """Weights of the exemplars' terms from all pages, and the terms that real text uses, from all long bodies.

    Both are bounded: by the exemplars' terms, and by the buckets that more than TYPICAL of all pages reach.
    """
    vocab = frozenset(index()[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        real: Counter = Counter()
        at: dict[str, int] = {}
        n = long = 0
        for b in batches:
            for text, roles in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n += 1
                if not text:
                    continue
                got.update(vocab.intersection(map(stem_of, tokens(text))))
                got.update({t for ts in shapes(text) for t in ts if t in vocab and (" " in t or t.isupper())})
                if roles and sum(roles) >= LONG:
                    long += 1
                    body = " ".join(t for (_, t), r in zip(content_lines(text), roles) if r == 1)
                    for w in set(map(stem_of, tokens(body))):
                        k = at.get(w)
                        if k is None:
                            k = at[w] = bucket(w)
                        real[k] += 1
                if len(at) > 1_000_000:
                    at.clear()
        got["\x00"], real[-1] = n, long
        ts, ks = list(got), list(real)
        cols = [pa.array(ts + [None] * len(ks), pa.string()), pa.array([None] * len(ts) + ks, pa.int32()), pa.array(list(got.values()) + list(real.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["t", "k", "n"])

    counts = written(labelled.select(content, "roles").mapInArrow(run, "t string, k int, n bigint").groupBy("t", "k").agg(F.sum("n").alias("n")), "terms")
    df = {r["t"]: r["n"] for r in counts.where("t is not null").toArrow().to_pylist()}
    long = counts.where("k = -1").agg(F.sum("n")).first()[0] or 0
    usual = counts.where((F.col("k") >= 0) & (F.col("n") > TYPICAL * long)).select("k", "n").toArrow()
    n = max(1, df.pop("\x00", 1))
    typical = {k: max(0.3, math.log(long / c)) for k, c in zip(usual.column("k").to_pylist(), usual.column("n").to_pylist())}
    return Residue({t: max(0.3, math.log(n / c)) for t, c in df.items()} | {"0": 0.5}, typical)


def is_residue(title: str | None, content: str | None, roles: list[int], model: LineModel, res: Residue) -> tuple[str | None, list[int]]:
    """(reason or None, roles) of a page; roles are empty where the wrapper knew none."""
    for part in (title, content):
        if part and res.placeholder(part):
            return "placeholder", roles
        if part and res.filler(part):
            return "filler", roles
    lines = [t for _, t in content_lines(content)]
    if not lines:
        return None, roles
    known = bool(roles)
    name = (title or "").strip().lower()
    first = heading_line(lines, title)
    body = [i for i in range(len(lines)) if not known or roles[i] == 1]
    heads = {i for i in body if i == first or name and name.startswith(lines[i].strip().lower())}
    # a page of a few lines that no site surrounds has to be less sure
    bare = len(body) == len(lines) <= LONG
    least = BARE if bare else CONTAINED
    strong, left, short = None, [], known or bare
    for i in body:
        if i in heads and short:
            continue
        held, label = res.passage(lines[i])
        if held >= least:
            if strong is None and label != "blank" and (len(stems(lines[i])) > 1 or label == "loading"):
                strong = label
        elif i not in heads:
            left.append(i)
            if short and (label == "genuine" or len(left) > FEW_LINES):
                return None, roles  # real text is left
    if short:
        said = [i for i in body if i not in heads]
        if left or not said:
            # the lines together, or nothing but the heading, may be the message
            held, label = res.passage("\n".join(lines[i] for i in said or body))
            strong = label if held >= least and label not in ("blank", "genuine") and (said or label != "scripts") and len(said) <= FEW_LINES else None
        return strong, roles
    if strong is None:
        return None, roles
    if left:
        z = model.scores(lines, title)
        if any(z[i] > 0 for i in left):
            return None, roles
    return strong, roles


def judged_pages(df: DataFrame, key: str, host: str, content: str, src: str, title: str):
    """(labelled pages, broadcast of the line model and the residue weights); the model and weights are bounded."""
    labelled = labelled_pages(df, key, host, content, src, title)
    model = train(labelled, key, content, title)
    res = learn_weights(labelled, content)
    return labelled, df.sparkSession.sparkContext.broadcast((model, res))


def find_residue(df: DataFrame, key: str, host: str, content: str, src: str, title: str) -> DataFrame:
    """(key, reason) of the pages that are residue or an error page, whatever their status says.

    Null or empty content and title are no cases; repeated rows stay repeated; an empty
    table gives an empty result.
    """
    labelled, both = judged_pages(df, key, host, content, src, title)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, res = both.value
        for b in batches:
            rows = zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())
            why = [is_residue(t, c, r, model, res)[0] for t, c, r in rows]
            at = [i for i, w in enumerate(why) if w]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array([why[i] for i in at], pa.string())], names=[key, "reason"])

    return labelled.select(key, title, content, "roles").mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, reason string")


def main_body(df: DataFrame, key: str, host: str, content: str, src: str, title: str) -> DataFrame:
    """(key, line_no, line) of the main body's lines of the pages that are no residue.

    line_no counts all lines of content from 1; empty lines never come out. Null or empty
    content gives nothing; repeated rows stay repeated.
    """
    labelled, both = judged_pages(df, key, host, content, src, title)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, res = both.value
        for b in batches:
            at, no, text = [], [], []
            rows = zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())
            for i, (t, c, r) in enumerate(rows):
                if not c or is_residue(t, c, r, model, res)[0]:
                    continue
                lines = content_lines(c)
                if not r:
                    r = model.label([x for _, x in lines], t)
                for (k, x), y in zip(lines, r):
                    if y == 1:
                        at.append(i)
                        no.append(k)
                        text.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), pa.array(text, pa.string())], names=[key, "line_no", "line"])

    return labelled.select(key, title, content, "roles").mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, line_no int, line string")
