"""Substring dedup (operator 6): prefix-partitioned suffix trees over words.

``repeats`` brings the segments that can hold a repeat of ``window`` words to
one task by their anchor. Here their suffixes are split by prefixes of variable
length: a group of suffixes with the same first words that is too large for
memory is split by one more word, and so on; small neighbouring groups are
taken together. Each group's subtree is built alone from its sorted suffixes.
The internal nodes at a depth of ``window`` words or more whose leaves have
different words before them are maximal repeats, and their leaves all the
occurrences.

Words are compared by 64-bit hashes. Edge cases: a null text has no words;
texts of fewer words than the window lose nothing; ids may be null or repeat
(see ``repeats``); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm import anchors, repeats
from starloom.llm.common import carried, map_arrow, texts, unpacked

WINDOW = 50
GRAM = 16
#: Suffixes in a group, unless they share all their words.
GROUP_SUFFIXES = 40_000

WORDS = repeats.Unit(raw=anchors.word_symbols, hashes=lambda raw: raw, dtype="u8")


@dataclass
class Subtree:
    """Internal nodes of a suffix tree below a prefix. ``leaves``: suffixes in
    order; node i has the leaves first[i] .. last[i] and the depth depth[i], and
    its parent is the node parent[i] (-1: above the least depth)."""

    leaves: np.ndarray
    first: np.ndarray
    last: np.ndarray
    depth: np.ndarray
    parent: np.ndarray


def prefix_groups(symbols: np.ndarray, left: np.ndarray, places: np.ndarray, limit: int, most: int) -> Iterator[np.ndarray]:
    """Split suffixes into groups by prefixes of variable length, at most
    ``most`` symbols; yields groups of about ``limit`` suffixes."""
    work, held, total = [(places, 0)], [], 0
    while work:
        group, depth = work.pop()
        if len(group) > limit and depth < most:
            at = np.minimum(group + depth, len(symbols) - 1)
            key = np.where(left[group] > depth, symbols[at], 0)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            work += [(x, depth + 1) for x in np.split(group[order], cuts)]
            continue
        if total and total + len(group) > limit:
            yield np.concatenate(held)
            held, total = [], 0
        held.append(group)
        total += len(group)
    if held:
        yield np.concatenate(held)


def subtree(codes: np.ndarray, left: np.ndarray, places: np.ndarray, longest: int, least: int) -> Subtree:
    """Build the tree of some suffixes. ``codes``: symbols as numbers from 1."""
    columns = np.arange(longest)
    inside = columns < left[places][:, None]
    table = np.where(inside, codes[np.minimum(places[:, None] + columns, len(codes) - 1)], 0).astype(">u4")
    order = np.argsort(np.ascontiguousarray(table).view(f"S{4 * longest}").ravel(), kind="stable")
    places, table, inside = places[order], table[order], inside[order]
    differs = np.ones((len(places), longest + 1), bool)
    differs[1:, :-1] = (table[1:] != table[:-1]) | ~inside[1:] | ~inside[:-1]
    common = differs.argmax(axis=1)
    common[:1] = 0
    nodes: list[list[int]] = []
    stack: list[list[int]] = []  # (depth, first leaf, children that are nodes)
    after = [*common.tolist(), 0]
    for i, depth in enumerate(after):
        first, children = i - 1, []
        while stack and stack[-1][0] > depth:
            top, first, below = stack.pop()
            for c in below:
                nodes[c][3] = len(nodes)
            nodes.append([first, i - 1, top, -1])
            if stack and stack[-1][0] >= depth:
                stack[-1][2].append(len(nodes) - 1)
            else:
                children = [len(nodes) - 1]
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append([depth, first, children])
    out = np.array(nodes, np.int64).reshape(-1, 4)
    return Subtree(places, out[:, 0], out[:, 1], out[:, 2], out[:, 3])


def maximal_repeats(symbols: np.ndarray, firsts: np.ndarray, window: int, limit: int = GROUP_SUFFIXES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, place, length): all occurrences of all maximal repeats of
    ``window`` symbols or more; segments start at ``firsts``."""
    n = len(symbols)
    ends = np.append(firsts[1:], n)
    left = np.repeat(ends, ends - firsts) - np.arange(n)
    codes = np.unique(symbols, return_inverse=True)[1] + 1
    before = np.zeros(n, np.int64)
    before[1:] = codes[:-1]
    before[firsts] = 0
    out, groups = [], 0
    for places in prefix_groups(codes, left, np.flatnonzero(left >= window), limit, window):
        if len(places) < 2:
            continue
        tree = subtree(codes, left, places, int(left[places].max()), window)
        previous = before[tree.leaves]
        differs = np.ones(len(places), np.int64)
        differs[1:] = (previous[1:] != previous[:-1]) | (previous[1:] == 0)
        total = np.cumsum(differs)
        diverse = (total[tree.last] > total[tree.first]) | (previous[tree.first] == 0)
        first, sizes, depth = tree.first[diverse], (tree.last - tree.first + 1)[diverse], tree.depth[diverse]
        group = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[group]
        out.append((group + groups, tree.leaves[at], depth[group]))
        groups += len(sizes)
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``keyed`` rows with the spans (start, length in words) of word sequences
    that also start in a document with a smaller id."""
    rows = repeats.keyed(docs)
    return repeats.with_spans(rows, repeats.repeats(rows, WORDS, maximal_repeats, window, gram, later_in_document=False))


def cut_words(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """(words, words removed, kept words joined by blanks, text without the
    removed words and the white space after them); the runs start .. end go."""
    words = data.split()  # ASCII white space, as the contract's words
    if not len(starts):
        return len(words), 0, b" ".join(words), data
    keep = np.ones(len(words), bool)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        keep[a:b] = False
    begins = np.append(anchors.word_bounds(data)[0], len(data))
    kept_text = data[: begins[0]] + b"".join(data[begins[i] : begins[i + 1]] for i in np.flatnonzero(keep).tolist())
    return len(words), int((~keep).sum()), b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k), kept_text


def remove_repeats(df: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """For each row of ``df``: (doc_id, n_words, n_removed, kept_sha256), the
    remaining text as ``kept``, white space and all, if asked for, and the
    columns ``keep``."""
    spans = repeated_words(texts(df, id_col, text_col, keep), window, gram)
    more, schema = carried(spans)

    def remove(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256") + ("kept",) * with_text}
            for text, found in zip(batch.column("text"), repeats.runs(batch.column("spans")), strict=True):
                n, removed, joined, rest = cut_words(text.as_py().encode(), *found)
                row = (n, removed, hashlib.sha256(joined).hexdigest()) + (rest.decode(),) * with_text
                for c, v in zip(out.values(), row, strict=True):
                    c.append(v)
            columns = {"doc_id": batch.column("doc_id")} | {c: pa.array(v, pa.int64() if c.startswith("n_") else pa.string()) for c, v in out.items()}
            yield pa.RecordBatch.from_pydict(columns | {c: batch.column(c) for c in more})

    kinds = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text + schema
    return unpacked(map_arrow(spans.select("doc_id", "text", "spans", *more), remove, kinds))
