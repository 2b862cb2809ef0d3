from sondar.llm import pages, residue

MESSAGE = "A página que você procura não existe ou foi removida. Verifique o endereço digitado. "
GENUINE = "As provas objetivas serão aplicadas em dois turnos e os gabaritos ficarão abertos a recurso por três dias úteis. "


def reason(content, title=None, roles=()):
    return residue.is_residue(title, content, list(roles), pages.LineModel({}, -1.0), residue.Residue({}))[0]


def test_a_long_line_is_looked_up_by_windows():
    assert len(MESSAGE * 9) > 700
    assert reason(MESSAGE * 9) == "error"
    assert reason(MESSAGE * 9, roles=[1]) == "error"
    assert reason(MESSAGE * 9 + GENUINE * 2, roles=[1]) is None
    assert reason(GENUINE * 6) is None


def test_filler_in_other_words_is_found_by_containment():
    for text in ("Insira o texto principal neste bloco e depois publique.", "Sample page: replace this copy with your own words.", "Reemplace este contenido por el texto definitivo."):
        assert reason(f"{GENUINE}\n{GENUINE}{text} {GENUINE}\n{GENUINE}") == "filler", text
    for text in ("Preencha à mão: Nome ____ Inscrição ____", "A página do concurso será atualizada após o título definitivo", "O texto da prova de redação deve ter de 20 a 30 linhas", "O edital substitui o anterior em todo o seu conteúdo"):
        assert reason(f"{GENUINE}\n{text}\n{GENUINE}") is None, text


def test_messages_in_other_words_are_found_where_nothing_else_is_left():
    typical = {residue.bucket(w): 3.0 for t in (GENUINE, "vagas para professor, provas, edital, candidato, município") for w in residue.stems(t)}
    res = residue.Residue({}, typical)
    for text in ("We are sorry: the server is overloaded", "Lo sentimos, algo ha fallado en el servidor", "Desculpe, este recurso saiu da rede; retorne mais tarde"):
        assert residue.is_residue("Prefeitura", f"Prefeitura\n{text}", [0, 1], pages.LineModel({}, -1.0), res)[0], text
        assert residue.is_residue("Prefeitura", f"Prefeitura\n{text}\n{GENUINE}", [0, 1, 1], pages.LineModel({}, -1.0), res)[0] is None
