"""One consistent form for texts that look the same.

A batch's texts become one array of positioned code points. Decompositions and
look-alike letters are joined to it by sorted search in a table that every worker
builds from the Unicode character database; combining marks are ordered by their
class with one stable sort, composed again level by level, and the strings are
rebuilt from the positions. Texts of plain ASCII are their own form.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.plans.lineage import written

#: Letters of other scripts that can't be told from a Latin letter.
LOOKALIKES = dict(
    zip(
        "АВЕЅЗІЈКМНОРСТУХԌҮԚԜаеѕіјорсухһԁԛԝӀ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϳ" "ՕՍօս" "ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ" "ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏚᎢᏙᎳᏃ" "ɑɡӏѵոհ",
        "ABES3IJKMHOPCTYXGYQWaesijopcyxhdqwI" "ABEZHIKMNOPTYXoj" "OUou" "BPdDTGKJCZFMNLSRVHWXYAEIOU" "ABCDEHJKLMPSTVWZ" "aglvnh",
    )
)
#: Hyphens of the same look, and marks that end a line.
HYPHENS = "‐‑‒⁃−﹣－˗"
LINE_ENDS = "  \u0085"
INVISIBLE = [(0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF9, 0xFFFB), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF), (0x0000, 0x0008), (0x000B, 0x000C), (0x000E, 0x001F), (0x007F, 0x0084), (0x0086, 0x009F)]
ZWJ = 0x200D


def _image(ch: str) -> str | None:
    """What a character is replaced by, before marks are ordered; None: itself."""
    cp = ord(ch)
    if any(a <= cp <= b for a, b in INVISIBLE):
        return ""
    if ch in LINE_ENDS:
        return "\n"
    if ch in HYPHENS:
        return "-"
    if ch in LOOKALIKES:
        return LOOKALIKES[ch]
    if unicodedata.category(ch) == "Zs":
        return " " if ch != " " else None
    tag = unicodedata.decomposition(ch)
    if not tag or 0xAC00 <= cp <= 0xD7A3:
        return None
    if tag.startswith("<"):
        kind = tag[1 : tag.index(">")]
        # letters in another style, and numerals that are written as one letter, are that letter
        if kind == "font" and ch.isalpha() or kind == "compat" and 0x2160 <= cp <= 0x217F and len(tag.split()) == 2:
            return chr(int(tag.split()[1], 16))
        if kind in ("wide", "narrow") or (kind == "compat" and 0xFB00 <= cp <= 0xFB06) or ch in "ĳĲŉǇǈǉǊǋǌǱǲǳ":
            return "".join(_image(x) if _image(x) is not None else x for x in map(lambda h: chr(int(h, 16)), tag.split()[1:]))
        return None
    return "".join(_image(x) if _image(x) is not None else x for x in unicodedata.normalize("NFD", ch))


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, ...]:
    """(keys, offsets, images) of replacements; (keys, classes) of marks; (pair keys, composed) of compositions."""
    keys, offs, img, marks, classes, pairs = [], [0], [], [], [], {}
    for cp in range(0x2FA20):
        if 0xD800 <= cp <= 0xDFFF or 0x3400 <= cp <= 0x4DBF or 0x4E00 <= cp <= 0xA000 or 0xAC00 <= cp <= 0xD7A3 or 0x17000 <= cp <= 0x1BFFF or 0x20000 <= cp < 0x2F800:
            continue
        ch = chr(cp)
        if c := unicodedata.combining(ch):
            marks.append(cp)
            classes.append(c)
        r = _image(ch)
        if r is not None:
            keys.append(cp)
            img.extend(map(ord, r))
            offs.append(len(img))
        tag = unicodedata.decomposition(ch)
        if tag and not tag.startswith("<") and " " in tag and unicodedata.normalize("NFC", ch) == ch:
            a, b = (int(h, 16) for h in tag.split())
            pairs[a << 32 | b] = cp
    for cp in range(0xE0000, 0xE1000):
        keys.append(cp)
        offs.append(len(img))
    pk = np.array(sorted(pairs), np.int64)
    return np.array(keys, np.int64), np.array(offs, np.int64), np.array(img, np.int64), np.array(marks, np.int64), np.array(classes, np.int64), pk, np.array([pairs[k] for k in pk.tolist()], np.int64)


def _lookup(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return keys[at] == x, at


def _pictograph(x: np.ndarray) -> np.ndarray:
    return ((x >= 0x1F000) & (x <= 0x1FAFF)) | ((x >= 0x2190) & (x <= 0x2BFF)) | (x == 0xFE0F)


def canonical(texts: list[str | None]) -> list[str | None]:
    """The consistent form of each text; null stays null, empty stays empty."""
    out = list(texts)
    todo = [i for i, t in enumerate(texts) if t and not (t.isascii() and t.replace("\n", "").replace("\t", "").isprintable())]
    if not todo:
        return out
    keys, offs, img, marks, classes, pk, pv = tables()
    parts = [np.frombuffer(texts[i].replace("\r\n", "\n").replace("\r", "\n").encode("utf-32-le", "surrogatepass"), np.uint32) for i in todo]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    cp = np.concatenate(parts).astype(np.int64)
    # a joiner between pictographs makes them one picture and stays
    near = np.concatenate(([0], cp[:-1]))
    far = np.concatenate((cp[1:], [0]))
    joins = (cp == ZWJ) & _pictograph(near) & _pictograph(far)
    hit, at = _lookup(keys, cp)
    hit &= ~joins
    lens = np.where(hit, offs[np.minimum(at, len(keys) - 1) + 1] - offs[at], 1)
    src = np.repeat(np.arange(len(cp)), lens)
    inner = np.arange(len(src)) - np.repeat(np.cumsum(lens) - lens, lens)
    new = np.where(hit[src], img[np.minimum(offs[at[src]] + inner, len(img) - 1)], cp[src])
    row = row[src]
    if len(new):
        is_mark, m = _lookup(marks, new)
        ccc = np.where(is_mark, classes[m], 0)
        starts = (ccc == 0) | np.concatenate(([True], row[1:] != row[:-1]))
        seg = np.cumsum(starts)
        if is_mark.any():
            order = np.lexsort((np.arange(len(new)), ccc, seg))
            new, ccc, row = new[order], ccc[order], row[order]
            new, keep = _compose(new, ccc, seg, pk, pv)
            new, row = new[keep], row[keep]
    counts = np.bincount(row, minlength=len(parts)) if len(new) else np.zeros(len(parts), np.int64)
    raw, begin = new.astype(np.uint32).tobytes(), 0
    for i, c in zip(todo, counts.tolist()):
        out[i] = raw[begin : begin + 4 * c].decode("utf-32-le", "surrogatepass")
        begin += 4 * c
    return out


def _compose(cp: np.ndarray, ccc: np.ndarray, seg: np.ndarray, pk: np.ndarray, pv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks joined to their starters, one mark of every segment at a time."""
    first = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
    size = np.diff(np.concatenate((first, [len(seg)])))
    keep = np.ones(len(cp), bool)
    cp = cp.copy()
    last = np.zeros(len(first), np.int64)  # class of the last mark that stayed
    usable = ccc[first] == 0
    open_ = np.flatnonzero((size > 1) & usable)
    k = 1
    while len(open_):
        a, b = first[open_], first[open_] + k
        hit, at = _lookup(pk, cp[a] << 32 | cp[b])
        hit &= last[open_] < ccc[b]
        cp[a[hit]] = pv[at[hit]]
        keep[b[hit]] = False
        last[open_[~hit]] = ccc[b[~hit]]
        k += 1
        open_ = open_[size[open_] > k]
    return cp, keep


def unify_text(df: DataFrame, key: str, text: str, out: str = "canonical") -> DataFrame:
    """(key, text, out) of every row of df: out is the consistent form of the text.

    Null and empty texts stay as they are, repeated rows stay repeated, a text's length is
    unbounded. Case, other letters, missing accents, digits, ordinal signs and
    punctuation are kept; line ends of any kind become a line feed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                s = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(canonical(s.column(1).to_pylist()), pa.string())], names=[key, text, out])

    return df.select(key, text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, `{text}` string, `{out}` string")


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key_a, key_b), key_a < key_b, of rows whose texts look the same but aren't the same string.

    Only digests travel: copies of one string are first gathered under it, and forms
    with a single string drop out before keys are paired. Null, empty and blank texts give no pair.
    """
    u = unify_text(df, key, text)
    u = u.where(F.col(key).isNotNull() & (F.trim("canonical") != "") & F.col("canonical").rlike(r"\S"))
    h = u.select(key, F.xxhash64("canonical").alias("f1"), F.xxhash64(F.lit(1), "canonical").alias("f2"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    h = written(h, "forms")
    several = h.groupBy("f1", "f2").agg(F.min("t1").alias("lo1"), F.max("t1").alias("hi1"), F.min("t2").alias("lo2"), F.max("t2").alias("hi2")).where("lo1 != hi1 or lo2 != hi2").select("f1", "f2")
    v = h.join(several, ["f1", "f2"], "left_semi")
    a, b = v.alias("a"), v.alias("b")
    j = a.join(b, (F.col("a.f1") == F.col("b.f1")) & (F.col("a.f2") == F.col("b.f2")) & (F.col(f"a.{key}") < F.col(f"b.{key}")) & ((F.col("a.t1") != F.col("b.t1")) | (F.col("a.t2") != F.col("b.t2"))))
    return j.select(F.col(f"a.{key}").alias(f"{key}_a"), F.col(f"b.{key}").alias(f"{key}_b")).distinct()


def lookalike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, strings, class_rows, links) of each row whose text looks like another string's.

    class_id names the form, strings counts its different strings, class_rows its rows and links the
    rows of other strings that look the same. Counts come from partial aggregation; no pairs are
    made, however many rows share a form. Null, empty and blank texts are in no class.
    """
    u = unify_text(df, key, text)
    u = u.where(F.col(key).isNotNull() & F.col("canonical").rlike(r"\S"))
    h = written(u.select(key, F.md5("canonical").alias("class_id"), F.md5(text).alias("__string")), "classes")
    strings = h.groupBy("class_id", "__string").agg(F.count(F.lit(1)).alias("__copies"))
    classes = strings.groupBy("class_id").agg(F.count(F.lit(1)).alias("strings"), F.sum("__copies").alias("class_rows")).where("strings > 1")
    several = strings.join(classes, "class_id")
    return h.join(several, ["class_id", "__string"]).select(key, "class_id", "strings", "class_rows", (F.col("class_rows") - F.col("__copies")).alias("links"))
