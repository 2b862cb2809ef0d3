"""Main body of pages by wrapper induction.

A page's source is read into a tree: body, the containers that hold lines, and the
lines. Of a tree only the skeleton travels: for each container the hashes of its tag
path and signature, its leaf labels and the hashes of its lines. Pages of one host are
aligned to a pivot page by simple tree matching (labels are tag paths and link-bearing
tags, never class names, which sites choose freely). Aligned slots whose text stays
constant over the host's pages are template; of those that vary, the slot that varies
most is the body, a level-1 heading that varies with the pages deciding between several.
What comes out is the host's wrapper: the signatures of its content containers, which
then label every page of the host. Hot hosts are split into groups of bounded size.

A page alone in its group has nothing to be aligned to: there the container of its level-1
heading is the wrapper. Pages without usable source (none, or lines under no container)
have no tree. Their lines are judged by a linear model fitted on a bounded sample of pages
that wrappers have labelled, from their own words, their neighbours' and their place.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.plans.lineage import written

#: Pages aligned together at about; labelled pages the line model is fitted on at most.
GROUP_PAGES, TRAIN_PAGES, EPOCHS = 64, 1500, 8
#: A line is constant if so many of a group's pages have it; a slot varies from so large a share of lines that aren't.
CONSTANT, VARIES = 0.2, 0.3
#: A signature speaks for itself if more than this share of its aligned containers are of one kind.
CLEAR = 0.8
_DROP = re.compile(r"<!--.*?-->|<(script|style|noscript|template|head)\b.*?</\1\s*>|<![^>]*>", re.S | re.I)
_LINK = re.compile(r"<a\b[^>]*>", re.I)
_HEAD = re.compile(r"<h1\b[^>]*>", re.I)
_CELL = re.compile(r"</t[dh]>\s*<t[dh]>", re.I)
_LINE = re.compile(r"</?(?:p|li|h[1-6]|dt|dd|ul|ol|dl|blockquote|pre|br|hr)\b[^>]*>", re.I)
_FLOW = re.compile(r"</?(?:a|b|i|em|strong|small|u|sup|sub|font|abbr|span|img|input|wbr)\b[^>]*>", re.I)
_BOX = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>")
_TABLE = {"table", "tbody", "thead", "tr"}


def read_tree(src: str) -> list[tuple[int, str, str]] | None:
    """One (container, signature, leaf label) for each line of text in the source, in order.

    A container is the innermost box around a line that has attributes of its own or a
    sectioning tag, or a cell of the outermost table; its signature is the path of tags
    with their attributes. None: there is no text, or text stands under no container.
    """
    at = src.find("<body")
    s = _DROP.sub("", src[at:] if at >= 0 else src)
    s = _FLOW.sub("", _LINE.sub("\n", _CELL.sub("\t", _HEAD.sub("\n\x02", _LINK.sub("\x01", s)))))
    stack: list[tuple[str, str, int]] = []  # (tag, signature or "" for a box that is part of a line, container)
    out: list[tuple[int, str, str]] = []
    pos = count = 0
    end = len(s)
    while True:
        m = _BOX.search(s, pos)
        stop = m.start() if m else end
        if stop > pos:
            chunk = s[pos:stop]
            if not chunk.isspace():
                sig, box = next(((g, c) for _, g, c in reversed(stack) if g), ("", 0))
                for t in chunk.split("\n"):
                    if t.strip(" \t\r\x01\x02"):
                        if not box:
                            return None
                        out.append((box, sig, "h1" if "\x02" in t else "a" if "\x01" in t else "l"))
        if not m:
            return out or None
        pos = m.end()
        tag = m.group(2).lower()
        if m.group(1):
            if any(x[0] == tag for x in stack):
                while stack and stack.pop()[0] != tag:
                    pass
            continue
        if tag in ("body", "html"):
            continue
        attrs = m.group(3)
        outer = next((g for _, g, _ in reversed(stack) if g), "")
        if tag in ("td", "th"):
            own = not outer
        elif tag in _TABLE:
            own = False
        else:
            own = tag != "div" or attrs != ""
        count += 1
        stack.append((tag, f"{outer}/{tag}{attrs}" if own else "", count))


def content_lines(content: str | None) -> list[tuple[int, str]]:
    """(line number from 1, text) of the non-empty lines."""
    return [(k, t) for k, t in enumerate((content or "").split("\n"), 1) if t.strip()]


@lru_cache(maxsize=100_000)
def tag_path(sig: str) -> str:
    """A signature without its attributes."""
    return re.sub(r" [^/]*", "", re.sub(r'"[^"]*"', '""', sig))


@lru_cache(maxsize=200_000)
def _leaf_match(a: tuple[tuple[str, int], ...], b: tuple[tuple[str, int], ...]) -> int:
    """Most leaf nodes that two sequences, given as runs of labels, can pair in order."""
    row = [0] * (len(b) + 1)
    for la, na in a:
        prev, diag = row[:], 0
        for j, (lb, nb) in enumerate(b, 1):
            row[j] = max(prev[j], row[j - 1], prev[j - 1] + (min(na, nb) if la == lb else 0))
    return row[-1]


def tree_match(a: list[tuple[str, tuple]], b: list[tuple[str, tuple]]) -> list[int]:
    """Simple tree matching of two pages' containers (label, leaf runs): for each of a the matched one of b, or -1."""
    m, n = len(a), len(b)
    w = [[0] * (n + 1) for _ in range(m + 1)]
    node = [[(1 + _leaf_match(x[1], y[1])) if x[0] == y[0] else 0 for y in b] for x in a]
    for i in range(1, m + 1):
        wi, wp, ni = w[i], w[i - 1], node[i - 1]
        for j in range(1, n + 1):
            best = wp[j] if wp[j] > wi[j - 1] else wi[j - 1]
            take = wp[j - 1] + ni[j - 1] if ni[j - 1] else 0
            wi[j] = take if take > best else best
    out, i, j = [-1] * m, m, n
    while i and j:
        if node[i - 1][j - 1] and w[i][j] == w[i - 1][j - 1] + node[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out[i] = j
        elif w[i][j] == w[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out


def hash32(text: str) -> int:
    """A signed 32-bit hash that is never 0 and the same in every worker."""
    return xxhash.xxh32_intdigest(text) - (1 << 31) or 1


class Skeleton:
    """A page's containers: label (path and leaf runs), signature, lines' hashes, and which one has the heading."""

    __slots__ = ("shape", "sigs", "lines", "heading", "head_text")

    def __init__(self, paths: list[int], sigs: list[int], runs: list[str], sizes: list[int], lines: list[int], heading: int):
        self.shape = [(p, _runs_of(r)) for p, r in zip(paths, runs)]
        self.sigs, self.heading = sigs, heading
        self.lines, at = [], 0
        for n in sizes:
            self.lines.append(lines[at : at + n])
            at += n
        self.head_text = None
        if heading >= 0:
            at = 0
            for x, n in self.shape[heading][1]:
                if x == "h":
                    self.head_text = self.lines[heading][at]
                    break
                at += n


@lru_cache(maxsize=50_000)
def _runs_of(text: str) -> tuple[tuple[str, int], ...]:
    return tuple((r[0], int(r[1:])) for r in text.split())


def skeleton(content: str | None, src: str | None) -> tuple[list[int], list[int], list[str], list[int], list[int], int] | None:
    """(paths, signatures, leaf runs, sizes, line hashes, heading's container or -1); None: no tree that fits the lines."""
    tree = read_tree(src) if src else None
    lines = content_lines(content)
    if tree is None or len(tree) != len(lines):
        return None
    paths, sigs, runs, sizes, heading, last = [], [], [], [], -1, None
    for c, sig, lab in tree:
        if c != last:
            paths.append(_hashed(tag_path(sig)))
            sigs.append(_hashed(sig))
            runs.append([])
            sizes.append(0)
            last = c
        sizes[-1] += 1
        if runs[-1] and runs[-1][-1][0] == lab[0]:
            runs[-1][-1][1] += 1
        else:
            runs[-1].append([lab[0], 1])
        if lab == "h1" and heading < 0:
            heading = len(sigs) - 1
    return paths, sigs, [" ".join(f"{x}{n}" for x, n in r) for r in runs], sizes, [hash32(t) for _, t in lines], heading


@lru_cache(maxsize=200_000)
def _hashed(text: str) -> int:
    return hash32(text)


def linked(runs: tuple[tuple[str, int], ...]) -> bool:
    """Whether most leaves of a container bear links."""
    return 2 * sum(n for x, n in runs if x == "a") > sum(n for _, n in runs)


def own_name(lines: list[int], sig: int) -> int:
    """A container's name by its page's lines and its signature."""
    return hash32(f"{sig} {lines}")


def induce(pages: list[Skeleton]) -> list[int]:
    """The wrapper of pages of one host: the signatures of their content containers; empty if it can't be told.

    Where alignment says of a container otherwise than its signature does, or where pages use a
    signature for both content and template, the container is named as an exception.
    """
    seen, own = set(), []
    for p in pages:  # repeated pages say nothing about what varies
        k = tuple(h for block in p.lines for h in block)
        if k not in seen:
            seen.add(k)
            own.append(p)
    if len(own) < 2:
        return sorted({p.sigs[p.heading] for p in own if p.heading >= 0})
    pivot = max(own, key=lambda p: len(p.shape))
    match = [tree_match(p.shape, pivot.shape) for p in own]
    has = Counter(h for p in own for h in {h for block in p.lines for h in block})
    most = max(1.0, CONSTANT * len(own))
    n = len(pivot.shape)
    total, varying, heads, text_links = [0] * n, [0] * n, [0] * n, [0] * n
    for p, m in zip(own, match):
        for b, s in enumerate(m):
            if s < 0:
                continue
            total[s] += len(p.lines[b])
            varying[s] += sum(has[h] <= most for h in p.lines[b])
            text_links[s] += 1 if linked(p.shape[b][1]) else -1
            heads[s] += b == p.heading and has[p.head_text] <= most
    free = [s for s in range(n) if total[s] and varying[s] >= VARIES * total[s] and (text_links[s] <= 0 or heads[s])]
    if not free:
        return sorted({p.sigs[p.heading] for p in own if p.heading >= 0})
    body = max(free, key=lambda s: (heads[s], varying[s]))
    # every slot that varies and is mostly written in the body slot's signatures is content
    mine = Counter(p.sigs[b] for p, m in zip(own, match) for b, s in enumerate(m) if s == body)
    like = [[0, 0] for _ in range(n)]
    for p, m in zip(own, match):
        for b, s in enumerate(m):
            if s >= 0:
                like[s][mine[p.sigs[b]] > 0] += 1
    good = {s for s in free if s == body or like[s][1] > like[s][0]}
    # a container says that its signature is template only if its own text is mostly constant
    votes: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    boxes = []
    for p, m in zip(own, match):
        page = [h for block in p.lines for h in block]
        for b, s in enumerate(m):
            fixed = 2 * sum(has[h] > most for h in p.lines[b]) >= len(p.lines[b])
            if s >= 0 and (s in good or fixed):
                votes[p.sigs[b]][s in good] += 1
                boxes.append((page, b, p.sigs[b], s))
    sure = {x for x, (no, yes) in votes.items() if yes > CLEAR * (no + yes)}
    never = {x for x, (no, yes) in votes.items() if no > CLEAR * (no + yes)}
    odd = set()
    for page, b, x, s in boxes:
        if x in sure and s not in good and like[s][0] > CLEAR * sum(like[s]) or x not in sure and x not in never and s in good:
            odd.add(own_name(page, x) ^ b)
    return sorted(sure | odd)


_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")


@lru_cache(maxsize=100_000)
def _masked(t: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(re.sub(r"[^\x00-\x7e]+|(?<=[a-z])\?+(?=[a-z])", "ç", re.sub(r"\d+", "0", t.lower()))))


def line_words(t: str) -> list[str]:
    """Words of a line with digits, and all beyond ASCII, masked, so that figures and garbled letters don't matter."""
    return list(_masked(t)) if len(t) < 400 else list(_masked.__wrapped__(t))


def _own(t: str) -> tuple[list[str], list[str], list[str]]:
    """(features of a line, those its neighbours see, those lines two away see)."""
    w = line_words(t)
    far = ["F" + " ".join(w[:2]), "L" + str(min(12, len(w)))]
    near = far + ["E" + (w[-1] if w else "")] + ["w" + x for x in set(w)]
    if "\t" in t:
        near.append("T")
    return near + ["b" + x + y for x, y in zip(w, w[1:])] + ["N" + str(min(8, len(t) // 25))], near, far


def heading_line(lines: list[str], title: str | None) -> int:
    """The first line that begins the title, or -1."""
    title = title or ""
    head = line_words(title)
    for i, t in enumerate(lines):
        if len(t) <= len(title):
            w = line_words(t)
            if len(w) >= 2 and head[: len(w)] == w:
                return i
    return -1


def _place(i: int, n: int, first: int) -> list[str]:
    f = ["e" + str(min(5, n - 1 - i)), "s" + str(min(5, i))]
    return f + (["h" + str(max(-3, min(6, i - first))), "H0" if i < first else "H1"] if first >= 0 else ["h?"])


_ZEROS = repeat(0.0)
_DIGITS = str.maketrans("123456789", "000000000")
#: Distance and tag of the lines seen from a line.
_SEEN = ((-1, "p", 1), (1, "n", 1), (-2, "q", 2), (2, "m", 2))


def line_features(lines: list[str], title: str | None) -> list[list[tuple[str, str]]]:
    """(tag, feature) of each line from itself (""), its neighbours and its place against the heading."""
    own = [_own(t) for t in lines]
    n, first = len(lines), heading_line(lines, title)
    out = []
    for i in range(n):
        f = [("", x) for x in own[i][0]]
        for d, tag, k in _SEEN:
            f += [(tag, x) for x in own[i + d][k]] if 0 <= i + d < n else [(tag, "^")]
        out.append(f + [("@", x) for x in _place(i, n, first)])
    return out


class LineModel:
    """Logistic regression over a vocabulary of features. What a line adds to itself and its neighbours is kept by its masked text."""

    def __init__(self, weights: dict[str, dict[str, float]], bias: float):
        self.weights, self.bias = weights, bias
        self.parts: dict[str, tuple[float, ...]] = {}

    def __getstate__(self):
        return self.weights, self.bias

    def __setstate__(self, state):
        self.weights, self.bias = state
        self.parts = {}

    def _part(self, t: str) -> tuple[float, ...]:
        got = self.parts.get(t)
        if got is None:
            own = _own(t)
            none: dict[str, float] = {}
            got = tuple(sum(map(self.weights.get(tag, none).get, own[k], _ZEROS)) for tag, k in (("", 0), ("p", 1), ("n", 1), ("q", 2), ("m", 2)))
            if len(self.parts) > 200_000:
                self.parts.clear()
            self.parts[t] = got
        return got

    def scores(self, lines: list[str], title: str | None) -> list[float]:
        """Log-odds of content for each line."""
        parts = [self._part(t.translate(_DIGITS)) for t in lines]
        n, first = len(lines), heading_line(lines, title)
        none: dict[str, float] = {}
        place = self.weights.get("@", none)
        z = [self.bias + p[0] + sum(place.get(x, 0.0) for x in _place(i, n, first)) for i, p in enumerate(parts)]
        for k, (d, tag, _) in enumerate(_SEEN, 1):
            edge = self.weights.get(tag, none).get("^", 0.0)
            for i in range(n):
                z[i] += parts[i + d][k] if 0 <= i + d < n else edge
        return z

    def label(self, lines: list[str], title: str | None) -> list[int]:
        """1 for content, 0 for template."""
        return [int(z > 0) for z in self.scores(lines, title)]


def fit(pages: list[tuple[list[str], str | None, list[int]]], seed: int = 5) -> LineModel:
    """The line model from labelled pages (lines, title, labels), by stochastic gradient descent."""
    seen: Counter = Counter()
    rows, ys = [], []
    for lines, title, lab in pages:
        for f, y in zip(line_features(lines, title), lab):
            seen.update(f)
            rows.append(f)
            ys.append(y)
    vocab = {k: i for i, k in enumerate(k for k, c in seen.items() if c >= 3)}
    if not rows or not vocab:
        return LineModel({}, 0.0)
    ids = [np.array([vocab[x] for x in f if x in vocab], np.int64) for f in rows]
    y = np.array(ys, np.float64)
    w, g2, bias = np.zeros(len(vocab)), np.full(len(vocab), 1e-2), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(ids))
        for a in range(0, len(order), 2048):
            part = order[a : a + 2048]
            flat = np.concatenate([ids[k] for k in part])
            sizes = np.array([len(ids[k]) for k in part])
            own = np.repeat(np.arange(len(part)), sizes)
            z = bias + np.bincount(own, weights=w[flat], minlength=len(part))
            err = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y[part]
            g = np.bincount(flat, weights=err[own], minlength=len(vocab)) / len(part) + 1e-6 * w
            g2 += g * g
            w -= 0.25 * g / np.sqrt(g2)
            bias -= 0.05 * err.mean()
    weights: dict[str, dict[str, float]] = {}
    for (tag, x), i in vocab.items():
        if abs(w[i]) > 1e-3:
            weights.setdefault(tag, {})[x] = float(w[i])
    return LineModel(weights, float(bias))


def skeletons(df: DataFrame, key: str, host: str, content: str, src: str, title: str) -> DataFrame:
    """Every page with its skeleton in place of its source, written once; pages without a tree have null there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        for b in batches:
            got = [skeleton(c, s) for c, s in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
            cols = [pa.array([g and g[k] for g in got], t) for k, t in enumerate((ints, ints, pa.list_(pa.string()), ints, ints, pa.int32()))]
            # a container of links is content only if the heading stands in it
            keys = [g and [0 if linked(_runs_of(r)) and k != g[5] else x for k, (x, r) in enumerate(zip(g[1], g[2]))] for g in got]
            names = [g and [x and own_name(g[4], x) ^ b for b, x in enumerate(k)] for g, k in zip(got, keys)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(4)), *cols, pa.array(keys, ints), pa.array(names, ints)], names=[key, "__h", title, content, "__paths", "__sigs", "__runs", "__sizes", "__lines", "__head", "__keys", "__names"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, F.coalesce(host, F.lit("")).alias("__h"), title, content, src)
    made = rows.mapInArrow(run, f"`{key}` {kind}, __h string, `{title}` string, `{content}` string, __paths array<int>, __sigs array<int>, __runs array<string>, __sizes array<int>, __lines array<int>, __head int, __keys array<int>, __names array<int>")
    return written(made, "skeletons")


def labelled_pages(df: DataFrame, key: str, host: str, content: str, src: str, title: str) -> DataFrame:
    """(key, title, content, roles) of every page: roles has 1 (content) or 0 for each non-empty line; empty: unknown.

    Only skeletons are shuffled, by (host, part): a host with more than GROUP_PAGES pages is
    split into parts of about so many, whatever the table's size. Sizes of hot hosts and the
    wrappers are joined without a hint, so the engine broadcasts them only where they are small.
    """
    pages = skeletons(df, key, host, content, src, title)
    hot = pages.where("__head is not null").groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > GROUP_PAGES)
    hot = written(hot.select("__h", F.ceil(F.col("__n") / GROUP_PAGES).alias("__parts")), "hosts")
    part = F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64(key), F.col("__parts"))).otherwise(F.lit(0)).alias("__part")
    parted = pages.join(hot, "__h", "left").select("*", part)
    bones = parted.where("__head is not null").select("__h", "__part", "__paths", "__sigs", "__runs", "__sizes", "__lines", "__head")

    def run(t: pa.Table) -> pa.Table:
        ps = [Skeleton(*x) for x in zip(*(t.column(k).to_pylist() for k in ("__paths", "__sigs", "__runs", "__sizes", "__lines", "__head")))]
        return pa.table({"__h": t.column("__h")[:1], "__part": t.column("__part")[:1], "__wrapper": pa.array([induce(ps)], pa.list_(pa.int32()))})

    wrappers = written(bones.groupBy("__h", "__part").applyInArrow(run, "__h string, __part bigint, __wrapper array<int>"), "wrappers")
    j = parted.select(key, title, content, "__h", "__part", "__sizes", "__keys", "__names").join(wrappers, ["__h", "__part"], "left")
    box = F.zip_with("__keys", "__names", lambda x, y: (F.array_contains("__wrapper", x) != F.array_contains("__wrapper", y)).cast("tinyint"))
    lines = F.flatten(F.zip_with(box, "__sizes", lambda r, n: F.array_repeat(r, n)))
    none = F.array().cast("array<tinyint>")
    return j.select(key, title, content, F.when(F.exists(box, lambda r: r == 1), lines).otherwise(none).alias("roles"))


def train(labelled: DataFrame, key: str, content: str, title: str, pages: int = TRAIN_PAGES) -> LineModel:
    """The line model, from at most `pages` wrapper-labelled pages, chosen by the hash of their key."""
    rows = labelled.where("size(roles) > 0").select(content, title, "roles").orderBy(F.xxhash64(key)).limit(pages).toArrow().to_pylist()
    return fit([([t for _, t in content_lines(r[content])], r[title], r["roles"]) for r in rows])
