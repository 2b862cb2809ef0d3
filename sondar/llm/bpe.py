"""Encoding a corpus with a public byte-level BPE tokenizer.

A partition's distinct pieces are laid out as one linked array of symbols. An index
maps each adjacent pair to all its positions; a heap holds the ranks that occur.
The lowest rank is applied to all its positions at once, and only the lists of the
pairs next to a merge are touched, so work is in proportion to the merges made and
a piece of any length costs no more than its bytes.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed by the public vocabulary: how a text is cut into pieces before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_PIECES = 500_000


def vocabulary_path(name: str = "byte_bpe_50k") -> str:
    """Where the public rank file lies: $SONDAR_TOKENIZERS, the installed package, or /opt/tokenizers."""
    base = os.environ.get("SONDAR_TOKENIZERS")
    if not base:
        spec = importlib.util.find_spec("public_tokenizers")
        base = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(base, f"{name}.tiktoken")


@lru_cache(maxsize=2)
def load(path: str) -> tuple[dict[tuple[int, int], int], list[int], regex.Pattern]:
    """(pair of ids -> merged id, byte -> id, piece pattern) of a rank file.

    A token's id is its rank; a pair merges if its joined bytes are a token.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pairs: dict[tuple[int, int], int] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                pairs[a, b] = rank
    return pairs, [ranks[bytes([b])] for b in range(256)], regex.compile(PATTERN)


def encode_pieces(pieces: list[bytes], pairs: dict[tuple[int, int], int], byte_id: list[int]) -> list[list[int]]:
    """Ids of each piece, by the pair occurrence index over all of them."""
    sym: list[int] = []
    ends: list[int] = []
    for p in pieces:
        sym.extend(map(byte_id.__getitem__, p))
        sym.append(-1)  # pieces never merge across this mark
        ends.append(len(sym))
    n = len(sym)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[int, list[int]] = {}
    pair_of: dict[int, dict[tuple[int, int], None]] = {}
    heap: list[int] = []

    index: dict[tuple[int, int], list[int]] = {}
    get = pairs.get
    for i in range(n - 1):
        key = (sym[i], sym[i + 1])
        if key in index:
            index[key].append(i)
        elif get(key) is not None:
            index[key] = [i]
    active: dict[int, list[tuple[int, int]]] = {}
    for key in index:
        r = pairs[key]
        if r in active:
            active[r].append(key)
        else:
            active[r] = [key]
            heappush(heap, r)
    del where, pair_of
    while heap:
        r = heappop(heap)
        for key in active.pop(r, ()):
            a, b = key
            for i in sorted(index.pop(key, ())):
                j = nxt[i]
                if sym[i] != a or j >= n or sym[j] != b:
                    continue
                sym[i], sym[j] = r, -2
                k = nxt[i] = nxt[j]
                if k < n:
                    prv[k] = i
                h = prv[i]
                for left, at in (((sym[h], r), h) if h >= 0 else (None, 0), ((r, sym[k]), i) if k < n else (None, 0)):
                    if left is None:
                        continue
                    rank = get(left)
                    if rank is None:
                        continue
                    if left in index:
                        index[left].append(at)
                    else:
                        index[left] = [at]
                        if rank in active:
                            active[rank].append(left)
                        else:
                            active[rank] = [left]
                            heappush(heap, rank)
    out, begin = [], 0
    for end in ends:
        out.append([s for s in sym[begin : end - 1] if s >= 0])
        begin = end
    return out


def encode_column(texts: list[str | None], path: str, cache: dict[str, list[int]]) -> list[list[int]]:
    """Ids of each text; null and empty texts give an empty list. New pieces of all texts are merged together."""
    pairs, byte_id, pattern = load(path)
    cut = [pattern.findall(t) if t else [] for t in texts]
    new = list({p for ps in cut for p in ps if p not in cache})
    for p, ids in zip(new, encode_pieces([p.encode("utf-8", "surrogatepass") for p in new], pairs, byte_id)):
        cache[p] = ids
    out = [[i for p in ps for i in cache[p]] for ps in cut]
    if len(cache) > CACHE_PIECES:
        cache.clear()
    return out


def encode_corpus(df: DataFrame, key: str, text: str, path: str | None = None, out: str = "ids", count_only: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(key, *keep, ids) of every row of df, without special tokens; ids is an array<int>.

    Null and empty texts give an empty list; strings that look like special tokens are
    ordinary text. Repeated rows stay repeated, null keys stay null. With count_only, `out` is the
    number of ids as an int. Nothing is shuffled: the piece cache of a Python worker
    holds at most CACHE_PIECES pieces and is emptied beyond that.
    """
    path = path or vocabulary_path()
    kept = [key, *(keep or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[int]] = {}
        for b in batches:
            texts = b.column(b.num_columns - 1)
            for at in range(0, b.num_rows, 512):
                ids = encode_column(texts.slice(at, 512).to_pylist(), path, cache)
                col = pa.array([len(x) for x in ids], pa.int32()) if count_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at, 512) for i in range(len(kept))), col], names=[*kept, out])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept) + f", `{out}` " + ("int" if count_only else "array<int>")
    return df.select(*kept, F.col(text).alias("__text")).mapInArrow(run, schema)
