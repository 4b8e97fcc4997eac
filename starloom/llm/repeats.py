"""Exact repeats of a fixed window length across a corpus, as Spark jobs.

Both substring operators use this flow and bring their own kernel, which finds
the maximal repeats inside the segments that one task holds (``anchors`` tells
what segments are):

1. Each task cuts its texts into segments. Of equal segments in a group of
   texts one goes on; rows that hold whole column blocks are shuffled by the
   anchor's hash.
2. By anchor: segments equal to an earlier one are repeats as a whole. Where an
   anchor has several different segments, the first of each kind is asked for.
3. The texts that hold such segments are joined by document, and the segments
   asked for are shuffled by anchor again, now with their symbols.
4. The kernel finds the maximal repeats of these segments.

Every repeated window lies in one segment of each of its occurrences, and these
have the same anchor, so nothing is missed; windows are judged on the input.
A repeat longer than a segment comes as a chain of overlapping ones, whose
union is the whole repeat.

Skew: anchors are chosen so that frequent grams are avoided. A bounded sample
of texts gives the grams that make up at least 1 / ``HEAVY_SHARE`` of its
anchors (so at most ``HEAVY_SHARE`` of them, the proven bound on what tasks
get). They are anchors only of windows that have no other gram, which are
those inside frequent passages, whose segments are equal and so collapse before
the shuffle. The sample changes which task does the work, never the result.
An anchor with more than ``ANCHOR_SYMBOLS`` symbols of different segments is
split by other grams of its windows before the kernel, so that a kernel's memory
does not grow with the corpus (not with ``all_occurrences``); the anchor's
segments themselves still meet in one task.

Rows: documents are known by (id, 64-bit hash of the text), so rows that share
an id but not the text are documents of their own, and rows that share both
count as one document, each with its result. A null id counts as the smallest.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import anchors
from starloom.llm.common import by_bytes, map_arrow, materialize

GROUP_BYTES = 8 << 20
#: Text for each bucket of anchors; its columns take less than that.
BUCKET_BYTES = 64 << 20
SAMPLE_TEXTS = 20_000
HEAVY_SHARE = 2048
#: Symbols that a kernel gets at once, unless one anchor has more.
KERNEL_SYMBOLS = 250_000
#: Symbols of one anchor from which on it is split by other grams.
ANCHOR_SYMBOLS = 2_000_000
#: Id of rows without one: below all others.
NO_ID = -(2**63)
NAMES = ["key", "tie", "start", "length"]


@dataclass(frozen=True)
class Unit:
    """What a text is made of. ``raw``: its symbols for the kernel; ``hashes``:
    their 64-bit hashes."""

    raw: Callable[[bytes], np.ndarray]
    hashes: Callable[[np.ndarray], np.ndarray]
    dtype: str


#: kernel(symbols, firsts, window) -> (group, place, length) arrays: a row for
#: each occurrence of each maximal repeat; segments start at ``firsts``.
Kernel = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def keyed(docs: DataFrame) -> DataFrame:
    """(key, tie) and the columns of ``texts`` rows."""
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("tie"), *docs.columns)


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Columns as one compressed block: a short one may hold few rows."""
    head = struct.pack("<B", len(arrays)) + b"".join(struct.pack("<cI", a.dtype.char.encode(), len(a)) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    heads = [struct.unpack_from("<cI", data, 1 + 5 * i) for i in range(data[0])]
    at, out = 1 + 5 * data[0], []
    for kind, n in heads:
        dtype = np.dtype(kind.decode())
        out.append(np.frombuffer(data, dtype, n, at))
        at += n * dtype.itemsize
    return out


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any of the columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _spread(bucket: np.ndarray, count: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, its rows' places) for each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(count + 1))
    return [(b, order[ends[b] : ends[b + 1]]) for b in range(count) if ends[b] < ends[b + 1]]


def _first_of(new: np.ndarray) -> np.ndarray:
    """For each row, the place of the latest row where ``new`` is true."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _union(key: np.ndarray, tie: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """The same spans, those of a document that meet made one."""
    order = np.lexsort((start, tie, key))
    key, tie, start, length = key[order], tie[order], start[order], length[order]
    new = _changes(key, tie)
    # ends so far, document by document: each document's places come after the last one's
    shift = (np.cumsum(new) - 1) * (int((start + length).max(initial=0)) + 1)
    ends = np.maximum.accumulate(start + length + shift)
    new[1:] |= start[1:] + shift[1:] > ends[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(key) - 1)[: len(first)]
    return [key[first], tie[first], start[first], ends[last] - shift[first] - start[first]]


def _heavy(docs: DataFrame, n: int, unit: Unit, window: int, gram: int) -> np.ndarray:
    """Sorted hashes of the most frequent anchors of a bounded sample of n texts."""

    def count(batches):
        for batch in batches:
            found = anchors.segments((unit.hashes(unit.raw(t.as_py().encode())) for t in batch.column("text")), window, gram).anchor
            values, counts = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], ["anchor", "n"])

    counts = map_arrow(docs.sample(min(1.0, SAMPLE_TEXTS / max(n, 1)), 17).select("text"), count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "anchor-counts")
    least = max(20, (counts.agg(F.sum("n")).first()[0] or 0) / HEAVY_SHARE)
    return np.sort(np.array([r.anchor for r in counts.filter(F.col("n") >= least).collect()], np.int64).view(np.uint64))


def _split(hashes: list[np.ndarray], window: int, gram: int, heavy: np.ndarray, most: int) -> anchors.Segments:
    """The segments of one anchor's segments by other grams than ``heavy``, and
    than those that would again have more than ``most`` symbols. Equal windows still have
    equal anchors."""
    while True:
        s = anchors.segments(iter(hashes), window, gram, heavy)
        values, number = np.unique(s.anchor, return_inverse=True)
        more = np.setdiff1d(values[np.bincount(number, weights=s.extent + window) > most], heavy)
        if not len(more):
            return s
        heavy = np.union1d(heavy, more)


def repeats(docs: DataFrame, unit: Unit, kernel: Kernel, window: int, gram: int, later_in_document: bool = True, all_occurrences: bool = False) -> DataFrame:
    """(key, tie, start, length) in symbols: spans of strings that also start
    earlier: in a smaller document or, with ``later_in_document``, also before
    in the same one. ``docs``: rows of ``keyed``.

    With ``all_occurrences``: (group, key, tie, start, length), a row for each
    occurrence of each maximal repeat, the first one too. Equal segments are a
    group of their own, whose first member stands for them in other groups."""
    spark = docs.sparkSession
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    # a task holds a bucket's columns, so buckets follow the text, whatever the setting
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    heavy = _heavy(docs, n, unit, window, gram)

    def place(s: anchors.Segments, which) -> np.ndarray:
        return s.start[which] << 24 | s.extent[which] << 12 | s.offset[which]

    def bucket_of(anchor: np.ndarray) -> np.ndarray:
        return ((anchor >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)

    def cut(batches):
        """Step 1: blocks of (anchor, content, document, place) and, of equal
        segments in the group, the later ones' (document, place) alone."""
        for batch in batches:
            for a, b in by_bytes(batch.column("text"), GROUP_BYTES):
                part = batch.slice(a, b - a)
                keys, ties = part.column("key").to_numpy(), part.column("tie").to_numpy()
                order = np.lexsort((ties, keys))  # document numbers follow the ids
                order = order[_changes(keys[order], ties[order])]  # rows that repeat are one document
                keys, ties, text = keys[order], ties[order], part.column("text")
                s = anchors.segments((unit.hashes(unit.raw(text[i].as_py().encode())) for i in order.tolist()), window, gram, heavy)
                rows = np.lexsort((s.start, s.doc, s.content, s.anchor))
                new = _changes(s.anchor[rows], s.content[rows])
                if all_occurrences:
                    keep = np.ones(len(rows), bool)
                elif later_in_document:
                    keep = new
                else:
                    keep = keys[s.doc[rows]] == keys[s.doc[rows[_first_of(new)]]]
                for bucket, at in _spread(bucket_of(s.anchor[rows]), buckets):
                    some, rest = rows[at[keep[at]]], rows[at[~keep[at]]]
                    some, rest = np.sort(some), np.sort(rest)
                    used, number = np.unique(s.doc[np.concatenate([some, rest])], return_inverse=True)
                    blob = _pack([s.anchor[some], s.content[some], place(s, some), place(s, rest), number.astype(np.uint32), keys[used], ties[used]])
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "block": [blob]})

    def compare(batches):
        """Step 2, for one bucket: repeats as (document, place), and the
        segments asked for, which have their anchor too."""
        parts = [_unpack(x) for batch in batches for x in batch.column("block").to_pylist()]
        if not parts:
            return
        anchor, content, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
        key = np.concatenate([p[5][p[4][: len(p[0])]] for p in parts])
        tie = np.concatenate([p[6][p[4][: len(p[0])]] for p in parts])
        order = np.lexsort((at, tie, key, content, anchor))
        anchor, content, at, key, tie = (x[order] for x in (anchor, content, at, key, tie))
        once = _changes(anchor, content, key, tie, at)  # rows may repeat
        anchor, content, at, key, tie = (x[once] for x in (anchor, content, at, key, tie))
        new = _changes(anchor, content)
        first = new if later_in_document else key == key[_first_of(new)]
        group = np.cumsum(_changes(anchor)) - 1
        several = np.bincount(group, weights=new)[group] > 1 if len(group) else new
        ask = first & several
        whole = ~first
        if all_occurrences:  # of a group with several members, all
            number = np.cumsum(new) - 1
            whole = np.bincount(number)[number] > 1 if len(number) else new
        rest_key, rest_tie = (np.concatenate([p[i][p[4][len(p[0]) :]] for p in parts]) for i in (5, 6))
        rest_at = np.concatenate([p[3] for p in parts])
        n = int(whole.sum()) + len(rest_at)
        columns = [pa.array(np.concatenate(x)) for x in ((key[whole], rest_key, key[ask]), (tie[whole], rest_tie, tie[ask]), (at[whole], rest_at, at[ask]))]
        columns.append(pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(anchor[ask].view(np.int64))]))
        if all_occurrences:
            columns.append(pa.concat_arrays([pa.array(anchors.mix(anchor ^ content)[whole].view(np.int64)), pa.nulls(int(ask.sum()), pa.int64())]))
        yield pa.RecordBatch.from_arrays(columns, ["key", "tie", "place", "anchor", "group"][: len(columns)])

    def fetch(batches):
        """Step 3: blocks of the segments asked for, with their symbols."""
        for batch in batches:
            rows, (place, anchor) = _lists(batch.column("asked"), "place", "anchor")
            key, tie = batch.column("key").to_numpy()[rows], batch.column("tie").to_numpy()[rows]
            start, extent = place >> 24, place >> 12 & 0xFFF
            symbols, last = [], -1
            for i, row in enumerate(rows.tolist()):
                if row != last:
                    raw, last = unit.raw(batch.column("text")[row].as_py().encode()), row
                symbols.append(raw[start[i] : start[i] + extent[i] + window].copy())
            size = np.array([len(x) for x in symbols], np.int64)
            for bucket, at in _spread(bucket_of(anchor.view(np.uint64)), buckets):
                blob = _pack([anchor[at], key[at], tie[at], start[at], size[at], np.concatenate([symbols[i] for i in at])])
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "block": [blob]})

    def refine(batches):
        """Step 4, for one bucket: the kernel over whole anchors."""
        parts = [_unpack(x) for batch in batches for x in batch.column("block").to_pylist()]
        if not parts:
            return
        anchor, key, tie, start, size = (np.concatenate([p[i] for p in parts]) for i in range(5))
        anchor = anchor.view(np.uint64)
        symbols = np.concatenate([p[5] for p in parts])
        del parts
        firsts = np.cumsum(size) - size
        order = np.lexsort((start, tie, key, anchor))
        order = order[_changes(*(x[order] for x in (anchor, key, tie, start)))]
        group_ends = np.append(np.flatnonzero(_changes(anchor[order]))[1:], len(order))
        total, begin = 0, 0
        found: list[tuple] = []
        sums = np.cumsum(size[order])

        def judged(rows, firsts, size, key, tie, start):
            """Occurrences that the kernel finds in these segments, by group."""
            local = np.cumsum(size[rows]) - size[rows]
            within = np.arange(int(size[rows].sum())) - np.repeat(local, size[rows])
            group, at, length = kernel(symbols[np.repeat(firsts[rows], size[rows]) + within], local, window)
            segment = np.searchsorted(local, at, "right") - 1
            k, t, s = key[rows][segment], tie[rows][segment], start[rows][segment] + at - local[segment]
            o = np.lexsort((s, t, k, group))  # the earliest occurrence of a group first
            return group[o], k[o], t[o], s[o], length[o]

        def later(group, k, t, s, length):
            new = _changes(group)
            which = ~new if later_in_document else k != k[_first_of(new)]
            found.append((k[which], t[which], s[which], length[which]))

        def split(rows):
            """One anchor's segments, by other grams."""
            own = np.union1d(heavy, anchor[rows[:1]])
            s = _split([unit.hashes(symbols[firsts[r] : firsts[r] + size[r]]) for r in rows.tolist()], window, gram, own, ANCHOR_SYMBOLS)
            k, t, at = key[rows][s.doc], tie[rows][s.doc], start[rows][s.doc] + s.start
            o = np.lexsort((at, t, k, s.content, s.anchor))
            name = np.cumsum(_changes(s.anchor[o], s.content[o]))
            later(name, k[o], t[o], at[o], s.extent[o] + window)  # equal ones are repeats as a whole
            new = _changes(name)
            o = o[new if later_in_document else k[o] == k[o][_first_of(new)]]
            n = s.extent + window
            block = np.cumsum(n[o]) // KERNEL_SYMBOLS
            block = block[_first_of(_changes(s.anchor[o]))]  # whole anchors
            for part in np.split(o, np.flatnonzero(_changes(block))[1:]):
                later(*judged(part, firsts[rows][s.doc] + s.start, n, k, t, at))

        for i, end in enumerate(group_ends):
            following = group_ends[i + 1] if i + 1 < len(group_ends) else None
            if following is not None and sums[following - 1] - total <= KERNEL_SYMBOLS:
                continue
            rows = order[begin:end]
            one = sums[end - 1] - total > ANCHOR_SYMBOLS and anchor[rows[0]] == anchor[rows[-1]]
            begin, total = end, sums[end - 1]
            if one and not all_occurrences:
                split(rows)
                continue
            group, k, t, s, length = judged(rows, firsts, size, key, tie, start)
            if not len(group):
                continue
            if all_occurrences:
                new = _changes(group)
                first = np.flatnonzero(new)
                name = anchors.mix(k[first].view(np.uint64) ^ anchors.mix(t[first].astype(np.uint64) << np.uint64(40) ^ s[first].astype(np.uint64)) + length[first].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (name.view(np.int64)[np.cumsum(new) - 1], k, t, s, length)], ["group", *NAMES])
            else:
                later(group, k, t, s, length)
        if found:
            k, t, s, length = _union(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(t), pa.array(s), pa.array(length)], NAMES)

    block = "bucket int, block binary"
    if all_occurrences:
        docs = docs.dropDuplicates(["key", "tie"])
    cut_blocks = map_arrow(docs.select("key", "tie", "text"), cut, block).repartitionById(buckets, "bucket")
    group = "group long, " if all_occurrences else ""
    places = materialize(map_arrow(cut_blocks, compare, "key long, tie long, place long, anchor long" + ", group long" * all_occurrences), "repeat-places")
    asked = places.filter("anchor is not null").groupBy("key", "tie").agg(F.collect_list(F.struct("place", "anchor")).alias("asked"))
    held = docs.select("key", "tie", "text").join(asked, ["key", "tie"])
    fetched = map_arrow(held, fetch, block).repartitionById(buckets, "bucket")
    whole = places.filter("anchor is null").withColumns({"start": F.shiftright("place", 24), "length": F.shiftright("place", 12).bitwiseAND(0xFFF) + window})
    refined = map_arrow(fetched, refine, group + "key long, tie long, start long, length long")
    return whole.select(*refined.columns).unionByName(refined)


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``keyed`` rows with the spans of their repeats (null: none)."""
    spans = found.groupBy("key", "tie").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    return docs.join(spans, ["key", "tie"], "left")


def _lists(column: pa.Array, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a column of lists of structs: the row of each element, and its fields."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = pc.list_flatten(column)
    return np.repeat(np.arange(len(column)), counts), [flat.field(n).to_numpy() for n in names]


def runs(column: pa.Array):
    """(starts, ends) of the maximal runs that each row's spans cover."""
    rows, (start, length) = _lists(column, "start", "length")
    cuts = np.searchsorted(rows, np.arange(len(column) + 1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield covered(start[a:b], length[a:b])


def covered(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs that some spans cover."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    ends = np.maximum.accumulate((starts + lengths)[order])
    starts = starts[order]
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    firsts = np.flatnonzero(new)
    return starts[firsts], ends[np.append(firsts[1:] - 1, len(starts) - 1)]
