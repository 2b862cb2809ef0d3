"""Finding and restoring text that was decoded with the wrong code page.

A wrong decoding is a substitution cipher: every letter beyond ASCII is written as
another symbol of one or more characters. The language is known from the rows whose
characters are all ordinary: counts of each such letter between its two neighbours.
Suspicious rows are given to the cipher source that explains them best; for each
source, expectation-maximization learns which letter each of its symbols stands for
from the neighbours it was seen between. The learned mapping is applied with
``str.translate`` and kept where it makes the text clearly likelier.

A source is one unknown swap of code pages, pooled over all rows it explains best. Code-page
tables start the mapping of common swaps. Rows whose symbols no such table makes likely text
of belong to sources without a table, one for each script and length of symbol that their
strange characters show: what those mean is learned from the language alone, each letter for
one symbol.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.plans.lineage import written

#: Letters and signs of the languages of the corpus that a wrong decoding can hit.
LETTERS = "áàâãéêíóôõúüçñÁÀÂÃÉÊÍÓÔÕÚÜÇÑ"
SIGNS = "ºª°§–—“”‘’…©«»¿¡•·±µ®€"
#: Names of code pages.
WRITTEN_AS = ("utf-8", "cp1252", "cp850", "mac_roman", "cp437")
READ_AS = ("latin-1", "cp1252", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "cp437", "cp850", "cp852", "cp866", "iso8859-2", "iso8859-5", "iso8859-7", "iso8859-9", "iso8859-15", "koi8-r", "mac_roman", "mac_latin2", "mac_cyrillic")
UNLIKELY = math.log(0.004)
FLOOR, COST, GAIN, PRIOR, ROUNDS = math.log(1e-5), 3.0, 5.0, 25.0, 8
#: A table fits a row if it makes so large a share of its symbols likely; a row has an unknown source from so many strange symbols on.
FIT, MIXED = 0.7, 3
ORDINARY = LETTERS + "ºª°§–—“”‘’…©«»¿¡•€"
_PAIRS = np.zeros(1 << 16, bool)
_TRIPLES = np.zeros(1 << 16, bool)
for _c in ORDINARY:
    _u = _c.encode()
    if len(_u) == 2:
        _PAIRS[_u[0] << 8 | _u[1]] = True
    elif _u[0] == 0xE2:
        _TRIPLES[_u[1] << 8 | _u[2]] = True


def suspicious(texts: pa.Array) -> np.ndarray:
    """Whether each text is looked at closely, from the bytes of all of them at once.

    It is if it has a character that isn't ordinary, a capital or sign where none belongs, or a
    question mark inside a word or where none belongs. Texts are told apart by line feeds.
    """
    out = np.zeros(len(texts), bool)
    for at in range(0, len(texts), 512):
        part = texts.slice(at, 512).cast(pa.large_string())
        n = len(part)
        off = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + n + 1]
        raw = np.frombuffer(part.buffers()[2], np.uint8)[off[0] : off[-1]] if part.buffers()[2] else np.zeros(0, np.uint8)
        ends = off[1:] - off[0]
        d = np.concatenate(([10], np.insert(raw, ends, 10), [10, 10, 10])).astype(np.uint16)
        c, p, x, y = d[1:-2], d[:-3], d[2:-1], d[3:]
        low = (c >= 97) & (c <= 122)
        alpha = lambda v: ((v | 32) >= 97) & ((v | 32) <= 122) & (v < 128)
        blank = lambda v: (v == 32) | ((v >= 9) & (v <= 13))
        bad = ((c < 32) & (c != 9) & (c != 10) & (c != 13)) | (c == 127) | (c >= 0xE3) | ((c >= 0xC4) & (c < 0xE2))
        two = (c == 0xC2) | (c == 0xC3)
        bad |= two & ~_PAIRS[np.minimum(c << 8 | x, 65535)]
        bad |= (c == 0xE2) & ~_TRIPLES[np.minimum((x & 255) << 8 | y, 65535)]
        cap = (c == 0xC3) & ((x == 0x82) | (x == 0x83))
        bad |= cap & ((y == 0xC2) | (y == 0xE2))
        again = np.concatenate((cap[2:], [False, False]))
        bad |= cap & again
        upper = np.concatenate(((c == 0xC3) & (x >= 0x80) & (x <= 0x9D), [False]))[1:]
        bad |= (low | ((p == 0xC3) & (c >= 0xA0) & (c <= 0xBF))) & upper
        q = c == 63
        if q.any():
            bad |= q & (alpha(x) | (x >= 0x80))
            bad |= q & (x == 32) & (((y >= 97) & (y <= 122)) | ((y >= 48) & (y <= 57))) & (alpha(p) | (p == 63))
            bad |= q & blank(p) & blank(x)
        hits = np.concatenate(([0], np.cumsum(bad)))
        stop = np.minimum(ends + np.arange(1, n + 1), len(bad))
        out[at : at + n] = hits[stop] > hits[np.concatenate(([0], stop[:-1]))]
    return out


_RUN = re.compile(r"[^\x00-\x7e]+")


def _garble(s: str, a: str, b: str) -> str | None:
    try:
        raw = s.encode(a)
    except UnicodeEncodeError:
        return None
    out = []
    for byte in raw:
        try:
            out.append(bytes([byte]).decode(b))
        except UnicodeDecodeError:
            out.append(chr(byte))  # undefined bytes pass through, as in browsers
    g = "".join(out)
    return g if g != s else None


@lru_cache(maxsize=1)
def families() -> dict[str, dict[str, str]]:
    """Cipher sources by name: symbol -> letter by its code pages. Equal tables appear once."""
    found: dict[str, dict[str, str]] = {}
    seen = set()
    for a in WRITTEN_AS:
        for b in READ_AS:
            if a == b or (a == "cp1252" and b in ("latin-1", "cp1254", "iso8859-15", "iso8859-9")):
                continue
            one = {}
            for t in LETTERS + SIGNS:
                g = _garble(t, a, b)
                if g and not g.isascii():
                    one[g] = t
            sig = tuple(sorted(one.items()))
            if sig in seen:
                continue
            seen.add(sig)
            found[f"{a}>{b}"] = one
            if a == "utf-8" and b in ("latin-1", "cp1252", "cp850", "cp437", "mac_roman"):
                two = {}
                for t in LETTERS + SIGNS:
                    g = _garble(t, a, b)
                    g2 = _garble(g, a, b) if g else None
                    if g2:
                        two[g2] = t
                found[f"{a}>{b} twice"] = two
    return found


@lru_cache(maxsize=1)
def _pattern_of() -> dict[str, re.Pattern]:
    return {f: re.compile("|".join(map(re.escape, sorted(t, key=len, reverse=True)))) for f, t in families().items()}


@lru_cache(maxsize=1)
def _by_char() -> dict[str, list[str]]:
    """Inverted index: character -> sources that have it in a symbol."""
    out = defaultdict(list)
    for f, t in families().items():
        for c in {c for s in t for c in s}:
            out[c].append(f)
    return dict(out)


def _side(c: str) -> str:
    """A neighbour as a class: letters as they are, digits, white space, other signs; beyond ASCII: unknown."""
    if not c or c.isspace():
        return " "
    if c.isascii():
        return c if c.isalpha() else "0" if c.isdigit() else "."
    return c if c in LETTERS else "*"


def language_counts(text: str, into: Counter) -> None:
    """Counts of (letter before, letter beyond ASCII, letter after)."""
    n = len(text)
    for m in re.finditer(r"[^\x00-\x7e]", text):
        i = m.start()
        into[_side(text[i - 1] if i else " ") + text[i] + _side(text[i + 1] if i + 1 < n else " ")] += 1


class Language:
    """P(letter | neighbours) over letters beyond ASCII, by bigrams of both sides with back-off."""

    def __init__(self, counts: dict[str, int]):
        self.before, self.after, self.single = Counter(), Counter(), Counter()
        self.b_all, self.a_all = Counter(), Counter()
        for k, c in counts.items():
            p, x, n = k
            self.single[x] += c
            self.before[p + x] += c
            self.after[x + n] += c
            self.b_all[p] += c
            self.a_all[n] += c
        self.total = max(1, sum(self.single.values()))
        self.memo: dict[tuple[str, str, str], float] = {}

    def log_p(self, p: str, x: str, n: str) -> float:
        k = (p, x, n)
        if k not in self.memo:
            base = (self.single[x] + 1e-3) / self.total
            left = (self.before[p + x] + 2 * base) / (self.b_all[p] + 2) if p != "*" else base
            right = (self.after[x + n] + 2 * base) / (self.a_all[n] + 2) if n != "*" else base
            self.memo[k] = max(FLOOR, min(0.0, math.log(left) + math.log(right) - math.log(base)))
        return self.memo[k]


def _native(text: str, a: int, b: int) -> bool:
    """Whether the run text[a:b] is part of a word wholly of one other script, which is no cipher."""
    s = text[a:b]
    if not any(c.isalpha() and ord(c) > 0x24F for c in s):
        return False
    left = text[a - 1] if a else " "
    right = text[b] if b < len(text) else " "
    return len(s) >= 3 and not (left.isalpha() or right.isalpha()) and all(ord(c) > 0x24F or not c.isalpha() for c in s)


def _units(family: str) -> re.Pattern:
    return _pattern_of().get(family) or (_TWO if family.endswith("2") else _ONE)


_ONE, _TWO = re.compile(r"[^\x00-\x7e]"), re.compile(r"[^\x00-\x7e]{1,2}")


@lru_cache(maxsize=4096)
def _script(c: str) -> str:
    return unicodedata.name(c, "NONE").split()[0]


def unknown_source(text: str, lang: Language) -> str | None:
    """A source without a table: the script of most strange characters, and 1 or 2 for the characters of a symbol.

    Only characters in or at words of ASCII letters count; None: there are too few.
    """
    seen: Counter = Counter()
    even = runs = 0
    for run in _RUN.finditer(text):
        a, b = run.span()
        if _native(text, a, b) or not (text[a - 1 : a].isalpha() or text[b : b + 1].isalpha()):
            continue
        strange = [c for c in run.group() if c not in ORDINARY and c != "\ufffd" and not c.isspace()]
        if strange:
            runs += 1
            even += (b - a) % 2 == 0
            seen.update(_script(c) for c in strange)
    if sum(seen.values()) < MIXED:
        return None
    return f"?{max(seen, key=lambda k: (seen[k], k))} {2 if even >= 0.7 * runs else 1}"


def fits(units: list[tuple[int, int, str, str, str]], table: dict[str, str], lang: Language) -> float:
    """The share of a row's symbols that the table turns into letters which are likely where they stand."""
    if not units:
        return 0.0
    return sum(u[2] in table and lang.log_p(u[3], table[u[2]], u[4]) >= UNLIKELY for u in units) / len(units)


def explain(text: str, family: str, table: dict[str, str], lang: Language) -> tuple[float, list[tuple[int, int, str, str, str]]]:
    """(gain, units): how much likelier the text becomes, and the symbols (begin, end, symbol, before, after)."""
    gain, units = 0.0, []
    n = len(text)
    for run in _RUN.finditer(text):
        a, b = run.span()
        if _native(text, a, b):
            continue
        for m in _units(family).finditer(text, a, b):
            i, j = m.span()
            sym = text[i:j]
            p, q = _side(text[i - 1] if i else " "), _side(text[j] if j < n else " ")
            p, q = (p if i > a else p), (q if j < b else q)
            if i > a:
                p = "*"
            if j < b:
                q = "*"
            here = 0.0
            for k in range(i, j):
                c = text[k]
                l, r = _side(text[k - 1] if k else " "), _side(text[k + 1] if k + 1 < n else " ")
                lone = not (text[k - 1 : k].isalpha() or text[k + 1 : k + 2].isalpha())
                here += max(lang.log_p(l, c, r), math.log(0.02) if lone and j - i == 1 and c not in LETTERS else math.log(0.002) if c in LETTERS and c.islower() else FLOOR)
            to = table.get(sym)
            units.append((i, j, sym, p, q))
            if to is not None:
                there = lang.log_p(p, to, q)
                if there > here:
                    gain += there - here
    return gain, units


def candidates(text: str, lang: Language) -> list[str]:
    """Sources that hold most of the characters that the language doesn't expect where they stand."""
    strange: Counter = Counter()
    n = len(text)
    for run in _RUN.finditer(text):
        a, b = run.span()
        if _native(text, a, b):
            continue
        for k in range(a, b):
            c = text[k]
            if lang.log_p(_side(text[k - 1] if k else " "), c, _side(text[k + 1] if k + 1 < n else " ")) < UNLIKELY:
                strange[c] += 1
    score: Counter = Counter()
    for c, k in strange.items():
        for f in _by_char().get(c, ()):
            score[f] += k
    best = max(score.values(), default=0)
    return [f for f in families() if score[f] >= 0.5 * best] if best else []


def lost(text: str) -> bool:
    """Whether letters were replaced by U+FFFD or by question marks."""
    if "�" in text:
        return True
    for m in re.finditer(r"\S*\?\S*", text):
        w = m.group()
        if re.search(r"[/=&@]|\w\.\w", w):
            continue
        if re.search(r"[^\W\d_]\?+[^\W\d_]", w):
            return True
        a, b = m.start(), m.end()
        after = text[b : b + 2]
        if re.fullmatch(r"[^\W\d_]+\?+", w) and re.fullmatch(r" [a-z]", after) and not re.match(r" (e|ou|o|a|y|se|sim|não|nao)\b", text[b : b + 6]):
            return True
        if re.fullmatch(r"\?[a-zA-Z]+", w) and (a == 0 or text[a - 1] in " \n(>") or w == "?" and re.match(r"\s\d{4}\b", text[b : b + 6]):
            return True
        if re.fullmatch(r"n\?|\d+\?", w) and re.match(r" \w", after):
            return True
    return False


def best_source(text: str, tables: dict[str, dict[str, str]], lang: Language) -> tuple[str | None, float]:
    """The source that makes the text likeliest, over the cost of assuming one; None: as it is.

    A learned source without a table is taken where it makes more of the symbols likely than
    the best known one does.
    """
    top, gain, share = None, 0.0, 0.0
    for f in candidates(text, lang):
        table = tables.get(f, families()[f])
        g, units = explain(text, f, table, lang)
        if g > gain + 1e-9:
            top, gain, share = f, g, fits(units, table, lang)
    if tables and (f := unknown_source(text, lang)) in tables:
        g, units = explain(text, f, tables[f], lang)
        if g - COST >= GAIN and g >= gain and fits(units, tables[f], lang) > max(share, 0.5):
            return f, g - COST
    return (top, gain - COST) if top and gain - COST >= GAIN else (None, gain - COST)


def source_of(text: str, lang: Language) -> str | None:
    """The source whose mapping the row helps to learn: a known one that fits it, or one without a table."""
    f, _ = best_source(text, {}, lang)
    if f is not None and fits(explain(text, f, families()[f], lang)[1], families()[f], lang) >= FIT:
        return f
    return unknown_source(text, lang) or f


def restored(text: str, table: dict[str, str], family: str, lang: Language) -> str:
    """The text with the source's symbols translated wherever that is likelier."""
    gain, units = explain(text, family, table, lang)
    symbols = {s: chr(0xF0000 + k) for k, s in enumerate(sorted(table))}
    back = {ord(c): table[s] for s, c in symbols.items()}
    out, at = [], 0
    for i, j, s, _, _ in units:
        out.append(text[at:i])
        out.append(symbols.get(s, s))
        at = j
    out.append(text[at:])
    return "".join(out).translate(back)


def decipher(symbols: dict[str, list[tuple[str, str, int]]], lang: Language, letters: list[str]) -> dict[str, str]:
    """EM without a table: symbol -> letter, from the language alone; each letter for one symbol.

    Every symbol starts as any letter by the language's frequencies. The expected letters
    of its sightings give its new shares; a letter that another symbol claims counts less.
    """
    names = sorted(symbols, key=lambda s: (-sum(c for _, _, c in symbols[s]), s))
    base = np.array([lang.single[x] + 1.0 for x in letters])
    p = [np.array([[lang.log_p(a, x, b) for x in letters] for a, b, _ in symbols[s]]) for s in names]
    n = [np.array([c for _, _, c in symbols[s]], float) for s in names]
    total = np.array([x.sum() for x in n])
    share = np.tile(base / base.sum(), (len(names), 1))
    for _ in range(4 * ROUNDS):
        got = np.empty_like(share)
        for k in range(len(names)):
            w = np.exp(p[k]) * share[k]
            got[k] = (n[k][:, None] * w / np.maximum(w.sum(1, keepdims=True), 1e-300)).sum(0) + 1e-6
        # a cipher is one to one: a symbol's claim on a letter is weighed against all others'
        claim = got / got.sum(0, keepdims=True)
        share = got * claim
        share /= share.sum(1, keepdims=True)
    out, used = {}, set()
    score = np.array([(n[k][:, None] * p[k]).sum(0) for k in range(len(names))])
    for k in sorted(range(len(names)), key=lambda k: -total[k]):
        for x in np.argsort(-(np.log(share[k] + 1e-12) + score[k] / max(1.0, total[k]))):
            if letters[x] not in used:
                used.add(letters[x])
                out[names[k]] = letters[x]
                break
    return out


def learn(contexts: dict[tuple[str, str, str, str], int], lang: Language) -> dict[str, dict[str, str]]:
    """EM for each source: symbol -> letter. contexts: (source, symbol, before, after) -> count."""
    by: dict[str, dict[str, list[tuple[str, str, int]]]] = defaultdict(lambda: defaultdict(list))
    for (f, s, p, n), c in contexts.items():
        by[f][s].append((p, n, c))
    letters = [x for x in LETTERS + SIGNS if lang.single[x]] or list(LETTERS)
    out = {}
    for f, symbols in by.items():
        if f.startswith("?"):
            out[f] = decipher(symbols, lang, letters)
            continue
        prior = families().get(f, {})
        share = {s: {x: 1.0 / len(letters) for x in letters} for s in symbols}
        for s in symbols:
            if s in prior and prior[s] in share[s]:
                share[s][prior[s]] += 0.5
        for _ in range(ROUNDS):
            for s, ctx in symbols.items():
                got = dict.fromkeys(letters, 1e-6)
                if s in prior and prior[s] in got:
                    got[prior[s]] += PRIOR
                for p, n, c in ctx:
                    w = {x: share[s][x] * math.exp(lang.log_p(p, x, n)) for x in letters}
                    z = sum(w.values()) or 1.0
                    for x, v in w.items():
                        got[x] += c * v / z
                z = sum(got.values())
                share[s] = {x: v / z for x, v in got.items()}
        # a known symbol is given another letter only on more than a few sightings
        learned = dict(prior)
        for s, d in share.items():
            x = max(d, key=d.get)
            if d[x] > 0.6 and (s not in prior or sum(c for _, _, c in symbols[s]) >= 2 * PRIOR):
                learned[s] = x
        out[f] = learned
    return out


def survey(df: DataFrame, key: str, text: str) -> tuple[Language, DataFrame]:
    """(language, suspicious rows) in one pass: counts over all rows whose characters are ordinary, and the other rows.

    The counts are bounded by the alphabet, not by the rows; the suspicious rows are
    written once and read twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        names = ["__key", "__text", "__k", "__n"]
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            odd = pa.array(suspicious(b.column(1)))
            for t in b.column(1).filter(pc.invert(odd)).to_pylist():
                language_counts(t, got)
            rows = b.filter(odd)
            if rows.num_rows:
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.nulls(rows.num_rows, pa.string()), pa.nulls(rows.num_rows, pa.int64())], names=names)
        if got:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(got), kind), pa.nulls(len(got), pa.string()), pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=names)

    rows = df.where(F.col(text).isNotNull()).select(key, text)
    both = written(rows.mapInArrow(run, f"__key {df.schema[key].dataType.simpleString()}, __text string, __k string, __n bigint"), "survey")
    counts = both.where("__k is not null").groupBy(F.col("__k").alias("k")).agg(F.sum("__n").alias("n")).toArrow()
    return Language(dict(zip(counts.column("k").to_pylist(), counts.column("n").to_pylist()))), both.where("__k is null").select(F.col("__key").alias(key), F.col("__text").alias(text))


def learn_sources(suspects: DataFrame, text: str, lang: Language) -> dict[str, dict[str, str]]:
    """Mappings of all sources from all suspicious rows; counts are bounded by symbols and neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                f = source_of(t, lang)
                if f is None:
                    continue
                for _, _, s, p, n in explain(t, f, families().get(f, {}), lang)[1]:
                    got[f, s, p, n] += 1
        cols = list(zip(*got)) if got else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols), pa.array(list(got.values()), pa.int64())], names=["f", "s", "p", "n", "c"])

    rows = suspects.select(text).mapInArrow(run, "f string, s string, p string, n string, c bigint")
    t = rows.groupBy("f", "s", "p", "n").agg(F.sum("c").alias("c")).toArrow().to_pylist()
    return learn({(r["f"], r["s"], r["p"], r["n"]): r["c"] for r in t}, lang)


def find_garbled(df: DataFrame, key: str, text: str, restore: bool = True) -> DataFrame:
    """(key, source, gain, lost, restored) of the rows whose text is garbled, in whole or in part.

    source is the cipher found (null if letters are only lost), gain the log-likelihood won,
    restored the text with the learned mapping applied (null where nothing can be restored).
    Null and empty texts are never garbled; repeated rows stay repeated; an empty table
    gives an empty result. Declared encodings are not consulted.
    """
    lang, suspects = survey(df, key, text)
    tables = learn_sources(suspects, text, lang)
    sc = df.sparkSession.sparkContext
    model = sc.broadcast((lang, tables))  # bounded by the alphabet

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, tables = model.value
        for b in batches:
            keep, fam, gains, gone, back = [], [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                f, g = best_source(t, tables, lang)
                away = lost(t)
                if f is None and not away:
                    continue
                keep.append(i)
                fam.append(f)
                gains.append(round(max(g, 0.0), 3))
                gone.append(away)
                back.append(restored(t, tables[f] if f in tables else families()[f], f, lang) if f and restore else None)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array(fam, pa.string()), pa.array(gains, pa.float64()), pa.array(gone, pa.bool_()), pa.array(back, pa.string())], names=[key, "source", "gain", "lost", "restored"])

    return suspects.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, source string, gain double, lost boolean, restored string")
