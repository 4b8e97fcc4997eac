"""Suffix-array dedup (operator 1): the tree of common-prefix intervals.

``repeats`` brings the segments that can hold a repeat of ``window`` bytes to
one task by their anchor. Here their suffixes are sorted (prefix doubling) into
an enhanced suffix array: order and lengths of common prefixes. A scan with a
stack gives the interval tree; an interval whose suffixes have different
symbols before them (or begin a segment) cannot be extended to the left, so it
is a maximal repeat, and *all* its suffixes are its occurrences, not only
neighbours in the array.

Matches never cross documents. Edge cases: a null text is an empty one; texts
shorter than the window lose nothing; ids may be null or repeat (see
``repeats``); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import anchors, repeats
from starloom.llm.common import map_arrow, texts

WINDOW = 100
GRAM = 32

BYTES = repeats.Unit(raw=lambda data: np.frombuffer(data, np.uint8), hashes=lambda raw: anchors.byte_symbols(raw), dtype="u1")


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 0."""
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(0, np.diff(keys[order]) != 0))
    return out


def enhanced_suffix_array(symbols: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, length of the prefix each shares with the one
    before). Segments begin at ``firsts``; suffixes end with their segment."""
    n = len(symbols)
    ends = np.append(firsts[1:], n)
    left = np.repeat(ends, ends - firsts) - np.arange(n)  # symbols to the segment's end
    longest = int(left.max(initial=0))

    def following(values: np.ndarray, step: int) -> np.ndarray:
        """What is ``step`` places later in the segment, 0 beyond its end."""
        out = np.zeros(n, np.int64)
        out[: n - step] = values[step:]
        out[left <= step] = 0
        return out

    # level k: tells the first 2**k symbols of each suffix apart, in their order
    rank = symbols.astype(np.int64) + 1 if symbols.dtype == np.uint8 else ranks(symbols) + 1
    levels, step, top = [(1, rank)], 1, int(rank.max(initial=0)) + 1
    while step < longest:
        if top > 1 << 31:  # else the numbers can be put together as they are
            rank = ranks(rank) + 1
            levels[-1] = (step, rank)
            top = n + 2
        rank = rank * top + following(rank, step)
        step, top = 2 * step, top * top
        levels.append((step, rank))
    order = np.argsort(rank)
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        most = np.minimum(left[a], left[b])
        got = np.zeros(n - 1, np.int64)
        for step, rank in reversed(levels):
            i, j = np.minimum(a + got, n - 1), np.minimum(b + got, n - 1)
            got += np.where((got + step <= most) & (rank[i] == rank[j]), step, 0)
        common[1:] = got
    return order, common


def intervals(common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The interval tree by a scan with a stack: (first, last, length) of each
    run of suffixes with a common prefix of ``length`` symbols, at least
    ``least``, that no longer run has with the same length."""
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    last = -2
    places = np.flatnonzero(common >= least)
    for i, length in zip(places.tolist(), common[places].tolist(), strict=True):
        if i != last + 1:
            while stack:
                top, first = stack.pop()
                found.append((first, last, top))
        first = i - 1
        while stack and stack[-1][0] > length:
            top, first = stack.pop()
            found.append((first, last, top))
        if not stack or stack[-1][0] < length:
            stack.append((length, first))
        last = i
    while stack:
        top, first = stack.pop()
        found.append((first, last, top))
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def left_diverse(symbols: np.ndarray, firsts: np.ndarray, order: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the suffixes of each interval have different symbols before
    them; the start of a segment differs from everything."""
    before = np.empty(len(symbols), np.int64)
    before[1:] = ranks(symbols)[:-1]
    before[firsts] = -1
    before = before[order]
    differs = np.ones(len(order), np.int64)
    differs[1:] = (before[1:] != before[:-1]) | (before[1:] == -1)
    total = np.cumsum(differs)
    return (total[last] > total[first]) | (before[first] == -1)


def occurrences(order: np.ndarray, first: np.ndarray, last: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, place, length), a row for each occurrence of each interval."""
    sizes = last - first + 1
    group = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[group]
    return group, order[at], length[group]


def maximal_repeats(symbols: np.ndarray, firsts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of all maximal repeats of ``window`` symbols or more."""
    order, common = enhanced_suffix_array(symbols, firsts)
    first, last, length = intervals(common, window)
    diverse = left_diverse(symbols, firsts, order, first, last)
    return occurrences(order, first[diverse], last[diverse], length[diverse])


def repeat_groups(df: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(group, doc_id, start, length): a row for each occurrence of each
    maximal repeat, in bytes; ``repeats.repeats`` tells how groups of equal
    segments stand for their members. Rows that repeat count once."""
    rows = repeats.keyed(texts(df, id_col, text_col))
    found = repeats.repeats(rows, BYTES, maximal_repeats, window, gram, all_occurrences=True)
    return found.select("group", F.when(F.col("key") != repeats.NO_ID, F.col("key")).alias("doc_id"), "start", "length")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``keyed`` rows with the spans (start, length in bytes) of strings that
    also start earlier. ``docs``: (doc_id, text)."""
    rows = repeats.keyed(docs)
    return repeats.with_spans(rows, repeats.repeats(rows, BYTES, maximal_repeats, window, gram))


def remove_repeats(df: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """For each row of ``df``: (doc_id, n_bytes, n_removed, n_spans,
    kept_sha256), and the kept bytes if asked for."""

    def remove(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256") + ("kept",) * with_text}
            for text, (starts, ends) in zip(batch.column("text"), repeats.runs(batch.column("spans")), strict=True):
                data = text.as_py().encode()
                edges = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if len(starts) else data
                row = (len(data), len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest()) + (kept,) * with_text
                for c, v in zip(out.values(), row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **out}, schema=arrow)

    arrow = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.binary())] * with_text)
    spans = repeated_spans(texts(df, id_col, text_col), window, gram).select("doc_id", "text", "spans")
    return map_arrow(spans, remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
