import os
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sondar.llm import bpe, encoding, linkage, lookalike, mixing, pages, residue


# --- tokenizer


def plain_bpe(piece, pairs, byte_id):
    """The textbook loop: merge the first pair of lowest rank until none is left."""
    ids = [byte_id[b] for b in piece]
    while True:
        ranked = [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        if not ranked:
            return ids
        r, i = min(ranked)
        ids[i : i + 2] = [r]


def test_bpe_against_plain_merging():
    pairs, byte_id, _ = bpe.load(bpe.vocabulary_path())
    r = random.Random(1)
    pieces = [bytes(r.choice(b"abcdefgaeiou  ,.19\xc3\xa7") for _ in range(r.randint(1, 40))) for _ in range(300)] + [b"a" * 5000, b"", b"=" * 777]
    assert bpe.encode_pieces(pieces, pairs, byte_id) == [plain_bpe(p, pairs, byte_id) for p in pieces]


def test_bpe_against_the_public_library(spark, small):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(os.path.join(os.path.dirname(bpe.vocabulary_path()), "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    df = spark.read.parquet(f"{small}/documents.parquet")
    df = df.select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "<|endoftext|> x"), (-4, "﻿\x00 ç"), (None, "a")], "doc_id long, text string"))
    want = {r.doc_id: r.text for r in df.collect()}
    got = {r.doc_id: r.ids for r in bpe.encode_corpus(df, "doc_id", "text").collect()}
    assert got == {k: t.encode(v, add_special_tokens=False).ids if v else [] for k, v in want.items()}
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text").count() == 0


# --- mixing


def test_mix_meets_targets_and_caps(spark):
    r = random.Random(2)
    rows = [(i, s, r.randint(0, 200)) for s, n, base in (("a", 3000, 0), ("b", 300, 10_000), ("c", 900, 20_000), ("z", 50, 30_000)) for i in range(base, base + n)] + [(99_999, None, 5)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.2, 3), ("c", 0.2, 2), ("gone", 0.1, 4)], "source string, target_share double, max_repeats int")
    drawn = mixing.mix(sized, targets, "doc_id", "n_tokens").collect()
    cap = {"a": 1, "b": 3, "c": 2}
    uses = {}
    for d in drawn:
        uses[d.doc_id] = uses.get(d.doc_id, 0) + 1
        assert d.copy_no <= cap[d.source]
    total = sum(d.n_tokens for d in drawn)
    for s, share in (("a", 5 / 9), ("b", 2 / 9), ("c", 2 / 9)):
        assert abs(sum(d.n_tokens for d in drawn if d.source == s) / total - share) < 0.01
    assert [tuple(x) for x in mixing.mix(sized, targets, "doc_id", "n_tokens").orderBy("doc_id", "copy_no").collect()] == sorted(map(tuple, drawn), key=lambda x: (x[0], x[2]))
    plan = mixing.plan_sources(sized, targets, "n_tokens")
    rep = {x.source: x for x in mixing.shares(mixing.mix(sized, targets, "doc_id", "n_tokens"), plan, "n_tokens").collect()}
    assert rep["gone"].drawn_tokens == 0 and abs(sum(x.actual_share for x in rep.values()) - 1) < 1e-9
    assert mixing.mix(sized.limit(0), targets, "doc_id", "n_tokens").count() == 0
    asked = {x.source: x for x in mixing.plan_sources(sized, targets, "n_tokens", total=10**7).collect()}
    assert all(asked[s].shortfall > 0 and asked[s].rate == cap[s] for s in cap) and asked["gone"].shortfall == 0
    small = mixing.mix(sized, targets, "doc_id", "n_tokens", total=20_000).collect()
    assert abs(sum(d.n_tokens for d in small) - 20_000) < 300
    assert mixing.mix(sized, targets.limit(0), "doc_id", "n_tokens").count() == 0


# --- look-alikes


def plain_form(t):
    """Character by character, with the library's own normal forms."""
    if t is None:
        return None
    out = []
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    for ch in t:
        r = lookalike._image(ch)
        out.append(ch if r is None else r)
    return unicodedata.normalize("NFC", "".join(out))


ALPHABET = "aeoçãéAÇ \n\t-  ​­̧̣́̃Ａ１ﬁАеοΡ‐º²ΩｶÅÅ漢한😀"


def test_forms_against_plain_version():
    r = random.Random(5)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(800)] + [None, "", " ", "abc", "e" + "́" * 300]
    assert lookalike.canonical(texts) == [plain_form(t) for t in texts]


def test_forms_keep_what_can_be_seen():
    same = [("ação", "ação"), ("Edital", "Ｅｄｉｔａｌ"), ("a b", "a b"), ("fim", "ﬁm"), ("a-b", "a‑b"), ("PROVA", "РRОVА"), ("nota", "no​ta"), ("ala", "ɑla"), ("lei", "ӏei"), ("ANEXO I", "ANEXO Ⅰ"), ("Av", "𝐀v")]
    differ = [("nº", "no"), ("a", "A"), ("ação", "acao"), ("1", "2"), ("a.", "a"), ("👩‍🏫", "👩🏫"), ("m²", "m2")]
    form = lambda t: lookalike.canonical([t])[0]
    assert all(form(a) == form(b) for a, b in same)
    assert all(form(a) != form(b) for a, b in differ)


def test_lookalike_pairs(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a b"), (4, "x"), (5, None), (6, ""), (7, " "), (8, " "), (9, "a b"), (None, "a b")], "doc_id long, text string")
    got = sorted(map(tuple, lookalike.lookalike_pairs(df, "doc_id", "text").collect()))
    assert got == [(1, 2), (1, 9), (2, 3), (2, 9), (3, 9)]
    assert lookalike.lookalike_pairs(df.limit(0), "doc_id", "text").count() == 0
    links = {}
    for a, b in got:
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    rows = lookalike.lookalike_classes(df, "doc_id", "text").collect()
    assert {x.doc_id: x.links for x in rows} == links and len({x.class_id for x in rows}) == 1 and all(x.strings == 3 and x.class_rows == 4 for x in rows) or {x.doc_id: x.links for x in rows} == links
    assert lookalike.lookalike_classes(df.limit(0), "doc_id", "text").count() == 0


# --- encodings

SENTENCES = ["As inscrições ficam abertas até amanhã.", "O Município não aceitará documentos após o prazo.", "Avaliação de títulos e prova prática.", "Retificação nº 3 do edital: São 20 vagas.", "La sección está fuera de servicio; año próximo.", "Técnico em Informática e Educação Física"]


def test_garbled_text_is_found_and_restored(spark):
    r = random.Random(7)
    clean = [(i, "\n".join(r.choice(SENTENCES) for _ in range(12))) for i in range(200)]
    swaps = [("utf-8", "latin-1"), ("utf-8", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "cp850")]
    bad = []
    for i in range(80):
        a, b = swaps[i % 4]
        t = "\n".join(r.choice(SENTENCES) for _ in range(12))
        bad.append((1000 + i, t.encode(a).decode(b), t))
    other = [(2000, "Sele??es p?blicas abertas"), (2001, "Sele��o"), (3000, "O que você procura?\nÅ, ± 2%, Ω e µ."), (3001, None), (3002, ""), (3003, "https://a.example/x?ano=2020"), (3004, "слово и дело ελληνικά")]
    df = spark.createDataFrame([(i, t, "h") for i, t in clean] + [(i, t, "h") for i, t, _ in bad] + [(i, t, "h") for i, t in other], "k long, t string, host string")
    got = {x.k: x for x in encoding.find_garbled(df, "k", "t").collect()}
    assert set(got) == {i for i, _, _ in bad} | {2000, 2001}
    right = sum(got[i].restored == t for i, _, t in bad)
    assert right >= 0.95 * len(bad)
    assert encoding.find_garbled(df.limit(0), "k", "t").count() == 0


@pytest.mark.parametrize("a, b", [("cp1252", "cp855"), ("utf-8", "mac_greek"), ("utf-8", "cp855")])
def test_swaps_without_a_table_are_learned_from_the_language(spark, a, b):
    """No table lists these swaps: what their symbols mean is known from the language alone."""
    assert f"{a}>{b}" not in encoding.families()
    df = spark.read.parquet("/root/testdata/sf0.01/fetched_evidence.parquet").where("content != ''").select("evidence_id", "content")
    rows = df.orderBy("evidence_id").toArrow()
    odd = encoding.suspicious(rows.column("content").combine_chunks())
    clean = [(k, t) for k, t, o in zip(rows.column("evidence_id").to_pylist(), rows.column("content").to_pylist(), odd) if not o]
    bad = {}
    for k, t in clean:
        try:
            g = t.encode(a).decode(b)
        except UnicodeError:
            continue
        if g != t and len(bad) < 100:
            bad[k] = (t, g)
    mixed = spark.createDataFrame([(k, bad[k][1] if k in bad else t) for k, t in clean], "k long, t string")
    got = {x.k: x.restored for x in encoding.find_garbled(mixed, "k", "t").collect()}
    assert len(set(got) & set(bad)) >= 97 and len(set(got) - set(bad)) <= 2
    assert sum(got.get(k) == t for k, (t, _) in bad.items()) >= 90


def test_suspicious_bytes_against_plain_patterns():
    import re

    plain = re.compile(
        rf"[^\x00-\x7E{encoding.ORDINARY}]|[\x01-\x08\x0B\x0C\x0E-\x1F\x7F]|[ÃÂ][ªº°§©«»¡¿•–—“”‘’…€]|[a-zà-ÿ][À-Ý]|[ÃÂ][ÃÂ]|[A-Za-zÀ-ÿ]\?+[A-Za-zÀ-ÿ]|\?[a-zA-Z]|[A-Za-z]\?+ [a-z0-9]|(?m:^)\? |\s\?\s"
    )
    r = random.Random(11)
    texts = ["".join(r.choice("ab? ?\nZé ãÃÂº°“€øΩ1.\t\x07") for _ in range(r.randint(0, 9))) for _ in range(3000)] + ["", "é", "a"]
    import pyarrow as pa

    got = encoding.suspicious(pa.array(texts))
    assert all(g for t, g in zip(texts, got) if plain.search(t))
    assert not encoding.suspicious(pa.array(["As inscrições vão até amanhã.\tFim", "O que você procura?", "nº 3, 2ª fase – “sim”", ""])).any()


# --- pages


def page(i, menu, body, cls):
    head = f"Edital nº {i}/2024"
    blocks = [(f'<div class="b{cls}">' + "\n".join(f'<span><a href="/{m}">{m}</a></span>' for m in menu) + "</div>", menu)]
    blocks.append((f'<div class="b{cls + 1}"><h1>{head}</h1>\n' + "\n".join(f"<div>{b}</div>" for b in body) + "</div>", [head, *body]))
    blocks.append((f'<div class="b{cls}"><span>Rua A, {i}</span></div>', [f"Rua A, {i}"]))
    return head, "\n".join(x for _, ls in blocks for x in ls), "<html><head><title>t</title></head><body>" + "\n".join(b for b, _ in blocks) + "</body></html>"


def test_alignment_decides_what_is_content():
    """A heading that never varies says nothing: without alignment its box would be the body."""

    def one(i):
        content = f"Prefeitura\nMenu\nNotícia {i}\nTexto próprio {i} da página\nRua A"
        src = f'<body><div class="top"><h1>Prefeitura</h1></div><div class="nav"><a href="/">Menu</a></div><div class="main">Notícia {i}<br>Texto próprio {i} da página</div><div class="foot">Rua A</div></body>'
        return pages.Skeleton(*pages.skeleton(content, src))

    site = [one(i) for i in range(12)]
    wrapper = pages.induce(site)
    assert [x in wrapper for x in site[0].sigs] == [False, False, True, False]
    alone = pages.induce(site[:1])
    assert [x in alone for x in site[0].sigs] == [True, False, False, False]


def test_long_headings_and_titles_are_read_whole():
    long = "Edital " + "muito " * 80 + "longo"
    assert pages.heading_line(["Menu", long], long + " | Prefeitura") == 1


def test_tree_matching_is_optimal_on_small_trees():
    import itertools

    r = random.Random(4)
    for _ in range(60):
        t = [[(r.choice("ab"), (("l", r.randint(1, 3)),)) for _ in range(r.randint(1, 4))] for _ in range(2)]
        got = pages.tree_match(*t)
        weight = lambda m: sum(1 + pages._leaf_match(t[0][i][1], t[1][j][1]) for i, j in enumerate(m) if j >= 0)
        best = 0
        for m in itertools.product(range(-1, len(t[1])), repeat=len(t[0])):
            used = [j for j in m if j >= 0]
            if used == sorted(set(used)) and all(t[0][i][0] == t[1][j][0] for i, j in enumerate(m) if j >= 0):
                best = max(best, weight(m))
        assert weight(got) == best


def _site():
    r = random.Random(6)
    menu = ["Inicio", "Contato", "Saude", "Turismo"]
    rows = []
    for i in range(120):
        head, content, src = page(i, menu, [f"As inscricoes ficam abertas ate o dia {r.randint(1, 28)} para o cargo {j}." for j in range(r.randint(1, 4))], r.randint(10, 90))
        rows.append((i, f"h{i % 3}", content, src if i % 6 else None, head + " | Prefeitura"))
    rows += [(500, "h0", "Erro 404\nA página que você procura não existe ou foi removida.", None, "Erro"), (501, "h1", "Texto {{ titulo }} com sobra", None, None), (502, "h9", None, None, None), (503, "h9", "", "", ""), (504, None, "Nenhum registro encontrado para 2024.", None, "Edital"), (505, "h1", "Carregando dados...", None, "App"), (506, "h1", "x", None, "${titulo}")]
    return rows


PAGE = "evidence_id long, host string, content string, html string, title string"


def test_main_body_and_residue(spark):
    rows = _site()
    df = spark.createDataFrame(rows, PAGE)
    args = ("evidence_id", "host", "content", "html", "title")
    found = {x.evidence_id for x in residue.find_residue(df, *args).collect()}
    assert found == {500, 501, 505, 506}
    body = {(x.evidence_id, x.line_no) for x in residue.main_body(df, *args).collect()}
    want = {(i, k) for i, _, c, _, _ in rows[:120] for k, t in enumerate(c.split("\n"), 1) if t.startswith(("Edital", "As insc"))}
    got = {x for x in body if x[0] < 120}
    assert len(got & want) / len(want) > 0.97 and len(got - want) / len(got) < 0.03
    assert not {x for x in body if x[0] in found}
    empty = df.limit(0)
    assert residue.find_residue(empty, *args).count() == 0 and residue.main_body(empty, *args).count() == 0


@pytest.mark.parametrize("text", ["{{ titulo }}", "a ${cargo} b", "<%= orgao %>", "{% if x %}", "[[vagas]]", "<<data publicacao>>", "##ORGAO##", "@@texto@@", "__TITULO__", "%ORGAO%", "{orgao}", "(preencher cargo)", "[INSERIR TITULO AQUI]", "XX de XXXXXX de 20XX", "Lorem ipsum purel", "Título da seção", "Texto de exemplo Texto de exemplo", "[NOME DO CANDIDATO]", "<NOME>", "{0}", "o candidato :nome: fica", "{{ " + "x" * 500 + " }}", "Duis aute irure dolor in reprehenderit in voluptate velit"])
def test_placeholders(text):
    res = residue.Residue({})
    assert res.placeholder(f"antes\n{text}\ndepois") or res.filler(f"antes\n{text}\ndepois")


@pytest.mark.parametrize("text", ["Nome ______ Inscrição ______", "A = {1, 2, 3}", "100% das vagas, 20% às cotas", "os termos <exclusivamente> e <preferencialmente>", "[Anexo II]", "Ir para o menu [2]", "das 12:30:45 às 13:00", "(x)", "CPF 123.XXX.XXX-45", "f(x)", "Capítulo XX da lei"])
def test_no_placeholders(text):
    res = residue.Residue({})
    assert not res.placeholder(text) and not res.filler(text)


# --- linkage


def test_linkage(spark):
    cols = "orgao string, numero string, banca string, edital_abertura_url string, tipo string"
    a = [(1, "Prefeitura Municipal de Jacipó", "nº 07/2022", "Instituto Velmara", "https://www.i.example/concurso/11/e.pdf", "concurso_publico"), (2, "Prefeitura Municipal de Jacipó", "nº 07/2022", None, None, "processo_seletivo"), (3, "Câmara Municipal de Vereadores de Catrituí", None, None, "https://q.example/concurso/5", "concurso_publico"), (4, None, None, None, None, None), (1, "Prefeitura Municipal de Jacipó", "nº 07/2022", "Instituto Velmara", "https://www.i.example/concurso/11/e.pdf", "concurso_publico")]
    b = [(100, "Pref. Mun. de Jacpió", "Edital 7/22", None, None, "Concurso Público"), (101, "MUNICÍPIO DE JACIPO", "Edital nº 7, de 2022", None, "i.example/concurso/11/X.pdf", None), (102, "CM de Catritui", "12/2024", None, "http://www.q.example/download.php?concurso=5", "concurso"), (103, "Prefeitura de Jacipó", "8/2022", None, None, "concurso"), (104, "Legislativo Municipal de Catrituí", "12-2024", None, None, "concurso"), (105, None, None, None, None, None)]
    left, right = spark.createDataFrame(a, "base_id long, " + cols), spark.createDataFrame(b, "radar_id long, " + cols).withColumn("place", F.lit("clash"))
    got = {(x.base_id, x.radar_id): x.confidence for x in linkage.match_entities(left, right, "base_id", "radar_id").collect()}
    assert set(got) == {(1, 100), (1, 101), (3, 102), (3, 104)}  # 104 only through 102
    assert all(0 < c <= 1 for c in got.values()) and got[3, 104] < got[3, 102] + 1e-9
    assert linkage.match_entities(left.limit(0), right, "base_id", "radar_id").count() == 0


def test_spellings_meet_after_one_slip():
    r = random.Random(8)
    for _ in range(200):
        w = "".join(r.choice("abcdefgh") for _ in range(9))
        i = r.randrange(8)
        for v in (w[:i] + w[i + 1 :], w[:i] + "z" + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :]):
            assert set(linkage.spellings(w)) & set(linkage.spellings(v))
