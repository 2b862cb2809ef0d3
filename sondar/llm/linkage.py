"""Matching announcements across sources that share no key, by collective graph linkage.

Rows are first reduced to profiles (equal normalised attributes), so repeated rows cost
nothing. Profiles of both tables meet in blocks of rare shared attributes: number and
year at places up to two letters apart, or the address of one announcement. An edge weighs
what its profiles share, by how rare the shared values are among all profiles: a number and
a place say most where their frequencies make a chance meeting unlikely. The graph is pruned
by meta-blocking (an edge far below the best of both its ends goes). Then the neighbourhood
decides: a profile that names no kind or number takes those of its best neighbours, and its
edges to others go; what is left supports, round by round until no score changes, the pairs at
both ends of each path, which fade with its length.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondar.plans.lineage import written

#: Words of a body's kind, by class; "" says nothing about the class.
KIND = {
    "": "municipal mun munic de do da dos das ddo dda ddos dde doo od ed ad e em a o the rs estado fundacao fund fundac instituto inst autonomo autonoma aut autarquia servidores serv publico publica",
    "executive": "prefeitura pref prefeit municipio pm",
    "chamber": "camara cam cm cmv legislativo vereadores ver poder",
    "culture": "cultura cultural cult fc",
    "health": "saude fms",
    "consortium": "consorcio cons intermunicipal interm cis",
    "pension": "previdencia prev ips ipsm ipm",
    "housing": "habitacao hab companhia cia ch",
    "water": "aguas agua departamento depto dep dpto daa saneamento esgoto",
    "traffic": "transito trans",
    "guard": "guarda gm civil",
}
_KIND_OF = {w: k for k, ws in KIND.items() for w in ws.split()}
_FIRST = ["consortium", "culture", "pension", "housing", "traffic", "guard", "water", "chamber", "health", "executive"]
_NUMBER = re.compile(r"(?<!\d)(\d{1,4})\s*(?:/|-|\.|,?\s+de\s|–|_)\s*(?:de\s+)?(\d{4}|\d{2})(?!\d)")
_FUSED = re.compile(r"\b([Dd][aeo]s?)(?=[A-ZÀ-Ý])|\b([Dd])\s+([aeo]s?)(?=[A-ZÀ-Ý])")
_NOT_BANCA = set("banca fundacao instituto associacao nucleo empresa de do da e concursos concurso consultoria selecoes selecao avaliacoes gestao publica provas exames integrada".split())
#: Least score of a match; what a common neighbour leaves of it; scores closer than this are equal.
ACCEPT, FADE, EPSILON = 0.62, 0.97, 1e-4
#: A neighbour speaks for a missing value if its score comes so near the best one; numbers are often mistyped.
NEAR = {"tipo": 0.02, "number": 0.15}


def fold(s: str | None) -> str:
    """Lower case without accents and repeated blanks; null as empty."""
    t = unicodedata.normalize("NFKD", s or "")
    return re.sub(r"\s+", " ", "".join(c for c in t if not unicodedata.combining(c)).lower()).strip()


def body_of(orgao: str | None) -> tuple[str, str]:
    """(place as one word, class) of the name of a public body; empty where it says nothing."""
    # a connector written into the name, as in "doZamalho" and "d oZamalho", is a word of its own
    parted = _FUSED.sub(lambda m: f"{m[1] or m[2] + m[3]} ", orgao or "")
    words = re.findall(r"[a-z0-9]+", re.sub(r"[\s/(-]+rs\)?\s*$", "", fold(parted)))
    kinds = {_KIND_OF[w] for w in words if w in _KIND_OF}
    place = "".join(w for w in words if w not in _KIND_OF)
    return place, next((k for k in _FIRST if k in kinds), "")


def number_of(numero: str | None) -> tuple[int | None, int | None]:
    """(number, year); two-digit years from 70 on are of the last century."""
    m = _NUMBER.search(fold(numero))
    if not m:
        return None, None
    y = int(m.group(2))
    return int(m.group(1)), y if y > 99 else 1900 + y if y >= 70 else 2000 + y


def kind_of(tipo: str | None) -> str:
    t = fold(tipo).replace("_", " ")
    if "seletiv" in t or t in ("pss", "ps", "selecao", "selecao publica"):
        return "selection"
    return "contest" if "concurso" in t else ""


def address_of(url: str | None) -> str:
    """The announcement an address points at: host and number; empty for pages of no single announcement."""
    u = fold(url)
    m = re.match(r"(?:[a-z]+://)?(?:www\.)?([^/?#]+)([^#]*)", u)
    if not m or "." not in m.group(1):
        return ""
    n = re.search(r"concurso[s]?(?:/|=|-)(\d+)", m.group(2)) or re.search(r"/anexo/(\d+)|/arquivos/(\d+)", m.group(2))
    return f"{m.group(1)}#{next(x for x in n.groups() if x)}" if n else ""


def banca_of(banca: str | None) -> list[str]:
    return sorted({w for w in re.findall(r"[a-z0-9]+", fold(banca)) if w not in _NOT_BANCA})


def _thirds(n: int) -> list[tuple[int, int]]:
    """(start, length) of the three parts that a place of n letters is cut into."""
    sizes = [n // 3, (n + 1) // 3, (n + 2) // 3]
    return [(sum(sizes[:i]), sizes[i]) for i in range(3)]


def spellings(place: str) -> list[str]:
    """Keys of a place; two places up to two letters apart share one, whatever their lengths.

    Two slips leave one third of a place as it is, moved by no more letters than there are
    slips before it, and than the lengths leave to the slips behind it. Each key is a third
    with its number and the length of its place: the place's own, and those which places
    up to two letters shorter could have in common with it.
    """
    out, n = set(), len(place)
    for m in range(max(0, n - 2), n + 1):
        for i, (start, size) in enumerate(_thirds(m)):
            for shift in range(max(-i, n - m - (2 - i)), min(i, n - m + 2 - i) + 1):
                if 0 <= start + shift <= n - size:
                    out.add(f"{m}.{i}.{place[start + shift : start + shift + size]}")
    return sorted(out)


_PROFILE = "place string, kind string, num int, year int, tipo string, banca array<string>, address string"


def profiled(df: DataFrame, key: str) -> DataFrame:
    """key and its profile, from orgao, numero, banca, edital_abertura_url and tipo; other columns are never read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            o, n, ba, u, t = (b.column(i).to_pylist() for i in range(1, 6))
            bodies, numbers = [body_of(x) for x in o], [number_of(x) for x in n]
            cols = [pa.array([x[0] for x in bodies]), pa.array([x[1] for x in bodies]), pa.array([x[0] for x in numbers], pa.int32()), pa.array([x[1] for x in numbers], pa.int32())]
            cols += [pa.array([kind_of(x) for x in t], pa.string()), pa.array([banca_of(x) for x in ba], pa.list_(pa.string())), pa.array([address_of(x) for x in u], pa.string())]
            cols[:2] = [c.cast(pa.string()) for c in cols[:2]]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[key, "place", "kind", "num", "year", "tipo", "banca", "address"])

    cols = [F.col(c).cast("string") for c in ("orgao", "numero", "banca", "edital_abertura_url", "tipo")]
    return df.where(F.col(key).isNotNull()).select(key, *cols).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, {_PROFILE}")


def _spelled(p: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, place in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = spellings(place)
                out += s
                ids += [i] * len(s)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["pid", "spelling"])

    return p.select("pid", "place").mapInArrow(run, "pid bigint, spelling string")


def _agrees(a: str, b: str):
    """Conditions on two joined profiles: no veto."""
    f = lambda c: (F.col(f"{a}.{c}"), F.col(f"{b}.{c}"))
    (k1, k2), (t1, t2), (n1, n2), (y1, y2), (p1, p2) = f("kind"), f("tipo"), f("num"), f("year"), f("place")
    same_number = n1.isNull() | n2.isNull() | ((n1 == n2) & (y1 == y2))
    return ((k1 == k2) | (k1 == "") | (k2 == "")) & ((t1 == t2) | (t1 == "") | (t2 == "")) & same_number & (F.levenshtein(p1, p2) <= 2)


def with_rarity(profiles: DataFrame) -> DataFrame:
    """profiles with the rarity, 0 to 1, of their number with year, place and address among all profiles.

    1 is a value that one profile has, 0 one that all have. Values are counted with partial
    aggregation and joined back by value; missing values are not counted.
    """
    values = F.array(
        F.struct(F.lit("n").alias("k"), F.when(F.col("num").isNotNull(), F.xxhash64(F.lit("n"), "num", "year")).alias("v")),
        F.struct(F.lit("p").alias("k"), F.xxhash64(F.lit("p"), "place").alias("v")),
        F.struct(F.lit("u").alias("k"), F.when(F.col("address") != "", F.xxhash64(F.lit("u"), "address")).alias("v")),
    )
    own = profiles.select("pid", F.explode(values).alias("x")).select("pid", "x.k", "x.v").where("v is not null")
    total = F.log1p(F.lit(float(max(1, profiles.count()))))
    counts = own.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    rare = own.join(counts, "v").withColumn("r", 1.0 - F.log(F.col("n").cast("double")) / total)
    wide = rare.groupBy("pid").agg(*[F.coalesce(F.max(F.when(F.col("k") == k, F.col("r"))), F.lit(0.0)).alias(f"rare_{k}") for k in "npu"])
    return profiles.join(wide, "pid")


def _weight(a: str, b: str):
    """What two profiles share: rare attributes (number with year and place, address) weigh most.

    Number and place count in full where both together are rarer than one in all profiles;
    places that differ in spelling are as rare as the more frequent one.
    """
    c = lambda x: (F.col(f"{a}.{x}"), F.col(f"{b}.{x}"))
    (n1, n2), (u1, u2), (b1, b2), (t1, t2), (k1, k2), (p1, p2), (r1, r2) = c("num"), c("address"), c("banca"), c("tipo"), c("kind"), c("place"), c("rare_p")
    both = n1.isNotNull() & n2.isNotNull()
    w = F.when(both, 0.54 + 0.08 * F.least(F.lit(1.0), F.col(f"{a}.rare_n") + F.least(r1, r2))).otherwise(0.0)
    u = F.col(f"{a}.rare_u")
    w = w + F.when((u1 == u2) & (u1 != ""), F.when(both, 0.21 + 0.04 * u).otherwise(0.5 + 0.08 * F.least(F.lit(1.0), u + F.least(r1, r2)))).otherwise(0.0)
    host = lambda u: F.split(F.regexp_extract(u, r"([^.#]+)\.[^.#]+(?:#|$)", 1), "#")
    w = w + F.when((F.size(b1) > 0) & (F.size(b2) > 0), F.when(F.arrays_overlap(F.array_union(b1, host(u1)), F.array_union(b2, host(u2))), 0.06).otherwise(-0.03)).otherwise(0.0)
    w = w + F.when((t1 == t2) & (t1 != ""), 0.05).otherwise(0.0) + F.when((k1 == k2) & (k1 != ""), 0.04).otherwise(-0.04)
    return w - 0.02 * F.levenshtein(p1, p2)


def contradicted(edges: DataFrame, profiles: DataFrame) -> DataFrame:
    """edges (i, j, s, i < j) without those that an end's best neighbours contradict.

    Where a profile names no kind of announcement, or no number, only neighbours stay whose
    value is also that of a neighbour within NEAR of its best; neighbours that name none stay.
    """
    said = profiles.select("pid", "tipo", F.coalesce(F.concat_ws("/", "num", "year"), F.lit("")).alias("number"))
    out = edges.join(said.select(F.col("pid").alias("i"), F.struct("tipo", "number").alias("a")), "i").join(said.select(F.col("pid").alias("j"), F.struct("tipo", "number").alias("b")), "j")
    bad = None
    for field, near in NEAR.items():
        for end, mine, theirs in (("i", "a", "b"), ("j", "b", "a")):
            silent = out.where(F.col(f"{mine}.{field}") == "").select(F.col(end).alias("e"), F.col(f"{theirs}.{field}").alias("v"), "s", "i", "j")
            bad = silent.withColumn("f", F.lit(field)).withColumn("near", F.lit(near)) if bad is None else bad.unionByName(silent.withColumn("f", F.lit(field)).withColumn("near", F.lit(near)))
    top = F.max("s").over(W.partitionBy("e", "f"))
    best = F.max("s").over(W.partitionBy("e", "f", "v"))
    bad = bad.withColumn("top", top).withColumn("best", best).where((F.col("v") != "") & (F.col("best") < F.col("top") - F.col("near"))).select("i", "j").distinct()
    return edges.join(bad, ["i", "j"], "left_anti")


def settled(edges: DataFrame, profiles: DataFrame) -> DataFrame:
    """Scores (i, j, s) of all pairs, refined by their neighbourhoods to a fixed point.

    Neighbours first contradict edges, then what is left supports the pairs at both ends of each
    path: a pair scores what it shares itself, or what the best path leaves of the weakest match on
    it, faded by its steps. Paths only join profiles between which nothing speaks. Last, neighbours
    contradict once more. Scores only rise, rounds double the length of paths, and no more than
    log(ACCEPT) / log(FADE) steps matter, so the rounds end without a limit on them: when
    neither the number of pairs nor the sum of scores changes by EPSILON.
    """
    p, q = profiles.alias("p"), profiles.alias("q")
    known, seen = written(contradicted(edges.where(F.col("s") >= ACCEPT), profiles), "direct"), None
    while True:
        now = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("s"), F.lit(0.0)).alias("s")).first()
        if seen is not None and now[0] == seen[0] and abs(now[1] - seen[1]) < EPSILON:
            return contradicted(known, profiles)
        seen = now
        half = known.unionByName(known.select(F.col("j").alias("i"), F.col("i").alias("j"), "s"))
        u, v = half.alias("u"), half.alias("v")
        via = u.join(v, (F.col("u.i") == F.col("v.i")) & (F.col("u.j") < F.col("v.j"))).select(F.col("u.j").alias("i"), F.col("v.j").alias("j"), (F.lit(FADE) * F.least("u.s", "v.s")).alias("s"))
        via = via.groupBy("i", "j").agg(F.max("s").alias("s")).where(F.col("s") >= ACCEPT)
        via = via.join(p, F.col("i") == F.col("p.pid")).join(q, F.col("j") == F.col("q.pid")).where(_agrees("p", "q")).select("i", "j", "s")
        known = written(known.unionByName(via).groupBy("i", "j").agg(F.max("s").alias("s")), "known")


def match_entities(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """(left_key, right_key, confidence) of every pair of rows that describe the same announcement.

    Repeated rows each come out. Another number, year or kind of announcement, another
    class of body or another place is never matched. Rows with a null key are left out; rows
    whose attributes are all missing match nothing. Empty tables give an empty result.
    """
    attrs = ["place", "kind", "num", "year", "tipo", "banca", "address"]
    a = profiled(left, left_key).select(F.lit(0).alias("side"), F.col(left_key).cast("string").alias("rid"), *attrs)
    b = profiled(right, right_key).select(F.lit(1).alias("side"), F.col(right_key).cast("string").alias("rid"), *attrs)
    rows = written(a.unionByName(b).withColumn("pid", F.xxhash64("place", "kind", F.coalesce("num", F.lit(-1)), F.coalesce("year", F.lit(-1)), "tipo", F.array_join("banca", " "), "address")), "rows")
    profiles = written(rows.where("place != ''").groupBy("pid").agg(*[F.first(c).alias(c) for c in attrs], F.min("side").alias("lo"), F.max("side").alias("hi")), "plain")
    profiles = written(with_rarity(profiles), "profiles")
    # blocks: a key of the place with number and year, or with the address. No pair that agrees is further apart, so an
    # address that is everywhere is split like any other
    spelled = _spelled(profiles).join(profiles.select("pid", "num", "year", "address"), "pid")
    by_number = spelled.where("num is not null").select("pid", F.xxhash64(F.lit("n"), "num", "year", "spelling").alias("block"))
    by_address = spelled.where("address != ''").select("pid", F.xxhash64(F.lit("u"), "address", "spelling").alias("block"))
    blocks = written(by_number.unionByName(by_address).distinct(), "blocks")
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, (F.col("x.block") == F.col("y.block")) & (F.col("x.pid") < F.col("y.pid"))).select(F.col("x.pid").alias("i"), F.col("y.pid").alias("j")).distinct()
    p, q = profiles.alias("p"), profiles.alias("q")
    linked = pairs.join(p, F.col("i") == F.col("p.pid")).join(q, F.col("j") == F.col("q.pid")).where(_agrees("p", "q"))
    edges = linked.select("i", "j", _weight("p", "q").alias("s")).where("s > 0.3")
    # meta-blocking: an edge stays if it comes near the best edge of one of its ends
    both = edges.unionByName(edges.select(F.col("j").alias("i"), F.col("i").alias("j"), "s"))
    both = both.withColumn("best", F.max("s").over(W.partitionBy("i"))).where("s >= 0.6 * best")
    edges = written(both.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "s").groupBy("i", "j").agg(F.max("s").alias("s")), "edges")
    good = settled(edges, profiles)
    # a profile agrees with itself if its attributes say enough
    own = profiles.where("lo != hi").select(F.col("pid").alias("i"), F.col("pid").alias("j"), F.when(F.col("num").isNotNull(), 0.95).when(F.col("address") != "", 0.85).otherwise(0.3).alias("s"))
    good = good.unionByName(good.select(F.col("j").alias("i"), F.col("i").alias("j"), "s")).unionByName(own.where(F.col("s") >= ACCEPT))
    l, r = rows.where("side = 0").select(F.col("rid").alias("lid"), F.col("pid").alias("i")), rows.where("side = 1").select(F.col("rid").alias("rid"), F.col("pid").alias("j"))
    out = good.select("i", "j", "s").join(l, "i").join(r, "j")
    return out.groupBy(F.col("lid").cast(left.schema[left_key].dataType).alias(left_key), F.col("rid").cast(right.schema[right_key].dataType).alias(right_key)).agg(F.round(F.least(F.max("s"), F.lit(1.0)), 4).alias("confidence"))
