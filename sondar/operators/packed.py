"""Several values packed in one field: one row per address, position kept.

The splitter never looks at a value by itself. It scans the Arrow data buffer of
a whole batch: byte classes, quote parity and delimiter masks are numpy arrays
over all bytes, from which child offsets follow; a list array over those offsets
is then flattened with its parents' ordinals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

_CLS = np.zeros(256, np.uint8)
WS, DELIM, QUOTE, OPEN, CLOSE, ALNUM, HOSTY = 1, 2, 4, 8, 16, 32, 64
for _b in b" \t\r\n\f\v":
    _CLS[_b] |= WS
for _b in b",;|":
    _CLS[_b] |= DELIM
for _b in b"\"'`":
    _CLS[_b] |= QUOTE
for _b in b"[({<":
    _CLS[_b] |= OPEN
for _b in b"])}>":
    _CLS[_b] |= CLOSE
for _b in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    _CLS[_b] |= ALNUM | HOSTY
for _b in b".-_":
    _CLS[_b] |= HOSTY
for _b in range(128, 256):
    _CLS[_b] |= HOSTY
_ALPHA = np.array([(65 <= b <= 90) or (97 <= b <= 122) for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SCHEME = _ALPHA | _DIGIT
_SCHEME[[43, 45]] = True


def _runs(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True; a run ends where a row begins."""
    before = np.concatenate(([False], mask[:-1]))
    after = np.concatenate((mask[1:], [False]))
    starts = mask & (~before | first[:-1])
    ends = mask & (~after | first[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _next_at(marks: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position, the first mark at or after it, or the row's end."""
    if not len(marks):
        return end.copy()
    k = np.searchsorted(marks, at)
    found = np.where(k < len(marks), marks[np.minimum(k, len(marks) - 1)], np.iinfo(np.int64).max)
    return np.minimum(found, end)


def split_addresses(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(parent ordinals, addresses) of a string array, in the order of the fields.

    Null, blank, ``no_existe`` and other text that is no address give nothing.
    """
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values.cast(pa.large_string()), "")
    values = pc.replace_substring_regex(values, "[“”„«»]", '"')
    values = pc.replace_substring_regex(values, "[‘’‚]", "'")
    values = pc.replace_substring_regex(values, "[ \u0085 -     　]", " ")
    values = pc.replace_substring_regex(values, "[﻿​-‏⁠­]", "")
    n = len(values)
    empty = np.zeros(0, np.int64), pa.array([], pa.string())
    if n == 0:
        return empty
    off = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + n + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)[off[0] : off[-1]] if values.buffers()[2] else np.zeros(0, np.uint8)
    off = off - off[0]
    size = len(data)
    if not size:
        return empty
    cls, low = _CLS[data], _LOWER[data]
    first = np.zeros(size + 1, bool)
    first[off] = True  # an empty row shares its start with the next one
    row_of = np.repeat(np.arange(n), np.diff(off))

    def at(k: int, what: bytes) -> np.ndarray:
        """Where the bytes `what` stand at distance k, within the buffer."""
        ok = np.ones(size, bool)
        for j, b in enumerate(what):
            s = k + j
            hit = np.zeros(size, bool)
            if s < size:
                hit[: size - s] = low[s:] == b
            ok &= hit
        return ok

    start = np.zeros(size, bool)
    # schemes: the run of scheme characters before "://"
    sep = np.flatnonzero(at(0, b"://"))
    run_s, run_e = _runs(_SCHEME[data], first)
    if len(sep):
        k = np.searchsorted(run_e, sep)
        ok = (k < len(run_e)) & (run_e[np.minimum(k, len(run_e) - 1)] == sep)
        s = run_s[np.minimum(k, len(run_s) - 1)]
        # "2.https" and "1-https": a scheme begins after the last character that isn't a letter
        letters_s, letters_e = _runs(_ALPHA[data], first)
        j = np.searchsorted(letters_e, sep)
        lok = (j < len(letters_e)) & (letters_e[np.minimum(j, len(letters_e) - 1)] == sep)
        s = np.where(lok, letters_s[np.minimum(j, len(letters_s) - 1)], s)
        start[s[ok & lok & (sep > s)]] = True
    start |= at(0, b"www.")
    # bare hosts: a run of host characters with an alphabetic last label or four numbers
    hosty = (cls & HOSTY) > 0
    inner = first[:-1].copy()
    edge = np.flatnonzero(hosty & (inner | ~np.concatenate(([False], hosty[:-1]))))
    stop = hosty & np.concatenate((inner[1:] | ~hosty[1:], [True]))
    ends = np.flatnonzero(stop) + 1
    if len(edge):
        dots = np.concatenate(([0], np.cumsum(data == 46)))
        digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
        alpha = np.concatenate(([0], np.cumsum(_ALPHA[data])))
        n_dots = dots[ends] - dots[edge]
        dot_at = np.flatnonzero(data == 46)
        last = np.where(n_dots > 0, dot_at[np.maximum(dots[ends] - 1, 0)] if len(dot_at) else 0, 0)
        tld = ends - last - 1
        named = (n_dots > 0) & (tld >= 2) & (alpha[ends] - alpha[np.minimum(last + 1, size)] == tld) & (last > edge)
        ip = (n_dots == 3) & (digits[ends] - digits[edge] + 3 == ends - edge) & (ends - edge >= 7)
        after = np.where(ends < size, data[np.minimum(ends, size - 1)], 32)
        inrow = ends < off[row_of[edge] + 1]
        follows = ~inrow | np.isin(after, np.frombuffer(b"/:?#", np.uint8)) | ((_CLS[after] & (WS | DELIM | QUOTE | CLOSE)) > 0)
        lead = (cls[edge] & ALNUM) > 0
        scheme_next = inrow & (after == 58) & at(0, b"://")[np.minimum(ends, size - 1)]
        start[edge[(named | ip) & follows & lead & ~scheme_next]] = True
    # a start counts only after the row's start, white space, a delimiter, a quote, an opening bracket or a list mark
    prev = np.concatenate(([32], data[:-1]))
    fresh = first[:-1] | ((_CLS[prev] & (WS | DELIM | QUOTE | OPEN)) > 0) | np.isin(prev, np.frombuffer(b"*.):>", np.uint8)) | (prev == 0xBA) | (prev == 0xB0) | (prev == 0xA2)
    hyphen = (prev == 45) & np.concatenate(([True], ((_CLS[np.concatenate(([32], data[:-1]))[:-1]] & (WS | DELIM)) > 0) | first[: size - 1])) if size > 1 else np.zeros(size, bool)
    begins = np.flatnonzero(start & (fresh | hyphen))
    if not len(begins):
        return empty
    # "www.x" inside "http://www.x", and hosts inside an address, are no starts: prev is "/" or part of a run, so already excluded
    row, end_of = row_of[begins], off[row_of[begins] + 1]
    # quotes: the run of quote characters right before an address opens it; parity of later runs closes it
    isq = (cls & QUOTE) > 0
    qs, qe = _runs(isq, first)
    opened = np.concatenate(([False], isq[:-1]))[begins] & (begins > off[row])
    quote_char = np.where(opened, prev[begins], 0)
    open_len = np.zeros(len(begins), np.int64)
    if len(qs):
        k = np.searchsorted(qe, begins)
        open_len = np.where(opened, begins - np.maximum(qs[np.minimum(k, len(qs) - 1)], off[row]), 0)
    close = np.full(len(begins), -1, np.int64)
    for q in (34, 39, 96):
        mine = opened & (quote_char == q)
        if not mine.any():
            continue
        rs, re_ = _runs(data == q, first)
        odd = (re_ - rs) % 2 == 1
        single = mine & (open_len == 1)
        close[single] = _next_at(re_[odd] - 1, begins[single], end_of[single])
        close[mine & ~single] = _next_at(rs, begins[mine & ~single], end_of[mine & ~single])
    closed = (close >= 0) & (close < end_of)
    # drop starts that lie within an earlier quoted value
    reach = np.maximum.accumulate(np.where(closed, close, -1))
    keep = np.concatenate(([True], begins[1:] > reach[:-1]))
    begins, row, end_of, close, closed = begins[keep], row[keep], end_of[keep], close[keep], closed[keep]
    blank = _next_at(np.flatnonzero((cls & WS) > 0), begins, end_of)
    nxt = np.concatenate((begins[1:], [size]))
    free = np.minimum(np.minimum(blank, end_of), nxt)
    stop_at = np.where(closed, close, free)
    # strip what can only surround an address
    junk = (cls & (WS | DELIM | QUOTE)) > 0
    tail = junk | np.isin(data, np.frombuffer(b"]}>[{<", np.uint8))
    paren = np.concatenate(([0], np.cumsum(data == 40)))
    moving = ~closed
    while True:
        last = data[np.maximum(stop_at - 1, 0)]
        lone = ((last == 41) | (last == 40)) & (paren[np.maximum(stop_at - 1, 0)] == paren[begins])
        go = (moving | ((_CLS[last] & WS) > 0)) & (stop_at > begins) & (tail[np.maximum(stop_at - 1, 0)] | lone)
        if not go.any():
            break
        stop_at = np.where(go, stop_at - 1, stop_at)
    good = stop_at > begins
    begins, row, stop_at, closed = begins[good], row[good], stop_at[good], closed[good]
    lens = stop_at - begins
    offs = np.concatenate(([0], np.cumsum(lens)))
    take = np.arange(offs[-1]) - np.repeat(offs[:-1], lens) + np.repeat(begins, lens)
    child = pa.Array.from_buffers(pa.large_string(), len(lens), [None, pa.py_buffer(offs.astype(np.int64).tobytes()), pa.py_buffer(data[take].tobytes())])
    doubled = pc.and_(pa.array(closed), pc.match_substring(child, '""'))
    child = pc.if_else(doubled, pc.replace_substring(child, '""', '"'), child)
    counts = np.bincount(row, minlength=n)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts)))), child)
    return np.asarray(pc.list_parent_indices(lists)), pc.list_flatten(lists).cast(pa.string())


def explode_packed(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field_name, pos, url) of each address packed in the given string fields of df.

    pos counts from 1 within a field. Null and blank fields, empty items and text
    that is no address give no rows and take no position; repeated rows of df give
    repeated rows; an empty df gives an empty result. A field's length is unbounded.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in fields:
                parent, urls = split_addresses(b.column(b.schema.get_field_index(name)))
                if not len(urls):
                    continue
                first = np.concatenate(([True], parent[1:] != parent[:-1]))
                at = np.arange(len(parent))
                pos = at - np.maximum.accumulate(np.where(first, at, 0)) + 1
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(parent)), pa.array([name] * len(urls), pa.string()), pa.array(pos.astype(np.int32)), urls], names=[key, "field_name", "pos", "url"]
                )

    return df.select(key, *fields).mapInArrow(run, f"`{key}` {kind}, field_name string, pos int, url string")
