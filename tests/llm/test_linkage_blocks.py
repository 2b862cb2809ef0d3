import random

from sondar.llm import linkage

COLS = "orgao string, numero string, banca string, edital_abertura_url string, tipo string"


def _pairs(spark, a, b):
    left, right = spark.createDataFrame(a, "base_id long, " + COLS), spark.createDataFrame(b, "radar_id long, " + COLS)
    return {(x.base_id, x.radar_id) for x in linkage.match_entities(left, right, "base_id", "radar_id").collect()}


def test_places_meet_after_two_slips():
    r = random.Random(9)
    for _ in range(3000):
        w = v = "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 18)))
        for _ in range(2):
            i, kind = r.randrange(len(v) + 1), r.randrange(3)
            v = v[:i] + "z" * (kind != 1) + v[i + (kind > 0) :]
        assert set(linkage.spellings(w)) & set(linkage.spellings(v)), (w, v)


def test_pairs_two_letters_apart_without_a_common_address(spark):
    a = [(1, "Câmara Municipal de Porto Gualezã da Serra", "23/2021", None, None, "concurso_publico"), (2, "Prefeitura de Ibá", "4/2020", None, None, "concurso_publico")]
    b = [(10, "CM DE PORTO GUALEZADA SERRA", "23-2021", None, None, "concurso_publico"), (20, "Prefeitura de Ibé", "4/2020", None, None, "concurso_publico")]
    assert _pairs(spark, a, b) == {(1, 10), (2, 20)}


def test_a_connector_written_into_the_name_is_no_part_of_the_place():
    for name in ("Prefeitura do Zamalho", "Prefeitura doZamalho", "Prefeitura d oZamalho", "Prefeitura dosZamalho"):
        assert linkage.body_of(name) == ("zamalho", "executive")
    assert linkage.body_of("Prefeitura de Dom Pedro")[0] == "dompedro" and linkage.body_of("Prefeitura de Dois Irmãos")[0] == "doisirmaos"


def test_an_address_that_is_everywhere_gives_the_same_pairs(spark):
    url = "https://q.example/concurso/5"
    a = [(1, "Prefeitura de Jacipoema", None, None, url, "concurso_publico"), (2, "Câmara de Ibá", "4/2020", None, url, "concurso_publico")]
    b = [(10, "Prefeitura de Jacpioema", "4/2020", None, url, "concurso_publico"), (20, "Câmara de Ibé", None, None, url, "concurso_publico"), (30, "Prefeitura de Jaciboena", None, None, url, "concurso_publico")]
    few = _pairs(spark, a, b)
    crowd = [(1000 + i, "Prefeitura de " + chr(97 + i % 26) * 9 + chr(97 + i // 26) * 9, None, None, url, "concurso_publico") for i in range(420)]
    assert few == {(1, 10), (2, 20), (1, 30)}
    assert {x for x in _pairs(spark, a, b + crowd) if x[1] < 1000} == few


def test_neighbours_find_a_pair_and_reject_one(spark):
    """2 and 20 share no block of their own, only neighbours; 3 names no kind, and its best neighbour is a contest."""
    u, v = "https://q.example/concurso/5", "https://q.example/concurso/6"
    a = [(2, "Câmara de Ibá", "4/2020", None, None, "concurso_publico"), (3, "Prefeitura de Jacipoema", "9/2021", "Velmara", v, None)]
    b = [(19, "Câmara de Ibá", "4/2020", None, u, "concurso_publico"), (20, "Câmara de Ibá", None, None, u, "concurso_publico")]
    b += [(30, "Prefeitura de Jacipoema", "9/2021", "Velmara", v, "concurso_publico"), (31, "Prefeitura de Jacipoema", "9/2021", "Outra", None, "processo_seletivo")]
    assert _pairs(spark, a, b) == {(2, 19), (2, 20), (3, 30)}
    assert (2, 20) not in _pairs(spark, a, [x for x in b if x[0] != 19])
    assert (3, 31) in _pairs(spark, a, [x for x in b if x[0] != 30])


def test_rare_values_weigh_more(spark):
    rows = [(i, f"lugar{i % 3}", "", i % 7, 2020, "", [], "u1" if i else "u2") for i in range(60)]
    p = spark.createDataFrame(rows, "pid long, place string, kind string, num int, year int, tipo string, banca array<string>, address string")
    r = {x.pid: x for x in linkage.with_rarity(p).collect()}
    assert len(r) == 60 and r[0].rare_u > 0.8 > 0.1 > r[1].rare_u and r[1].rare_n > r[1].rare_p
