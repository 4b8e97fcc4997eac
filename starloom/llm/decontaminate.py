"""Benchmark decontamination (operator 9): a BM25 inverted index of the test
items, searched by block-max WAND with every passage of every document.

* Terms are runs of letters and digits, A-Z in lower case; an item's score for
  a passage is its BM25 score for the passage's distinct terms, divided by the
  item's score for itself, so 1 means that all its terms are there.
* Items are in length classes, by powers of two of their terms from
  ``MIN_STRIDE`` on. Passages are windows of 2 n terms at every n terms, n the
  class's greatest length, so each occurrence of an item lies whole in some
  passage. A text without terms has no passage.
* Items are in blocks of ``BLOCK_ITEMS``. A passage whose terms' greatest impacts
  in a block add up to less than the threshold for every block reaches no item;
  one table row for each term gives these sums. The others run WAND: cursors over postings in item order, the pivot from the
  terms' greatest impacts, then the bounds of the blocks that hold the pivot,
  and only then full scores. All items at or above the threshold are returned.
* An item found is verified in spans of the passage, of 2 m terms at every m
  terms, m the item's own length (at least ``MIN_SPAN``): in one span the score
  must reach the threshold again, and its question (all but the last quarter of
  its terms, or what stands before its last question mark) and its answer (the
  rest) must both overlap with the span, by shares of their neighbouring
  term pairs (of their terms, if there is one term only). What is found of an
  item does not depend on the other items' lengths or on shards.

An index is built for one shard of items at a time, of at most ``SHARD_BYTES``
of text (or one longer item), with collection statistics over all items, and
written to the shared folder. One map goes over the documents; for each group of
texts a task reads one shard after the other and holds one at a time: a larger
benchmark takes more time, not more memory. Documents are not shuffled.

Edge cases: items that are null or without terms match nothing; items that
repeat are found each by its id; items with a null id count in ``n_items``, each
row on its own, and ``item_ids`` lacks them; a null text has no passage; rows with null or
equal ids are rows of their own; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.anchors import word_bounds, word_symbols
from starloom.llm.common import by_bytes, carried, create, map_arrow, materialize, open_shared, shared_folder, texts, unpacked

K1, B = 1.2, 0.75
THRESHOLD = 0.6
QUESTION_SHARE = 0.6
ANSWER_SHARE = 0.5
MIN_STRIDE = 64
MIN_SPAN = 16
BLOCK_POSTINGS = 16
#: Items in a block of the first bound, and bound on the cells of its table.
BLOCK_ITEMS = 4
TABLE_CELLS = 16 << 20
SHARD_BYTES = 512 << 10
GROUP_BYTES = 4 << 20
#: So many times larger groups, at most, where a group reads several shards.
LARGER_GROUPS = 4

#: Bytes between terms: ASCII but letters and digits.
BETWEEN = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def terms(text: str) -> np.ndarray:
    """Hashes of a text's terms, in order."""
    return word_symbols(text.encode().lower(), BETWEEN)


@dataclass
class Item:
    key: int | tuple[int]  # the id; of an item without one, (its number,)
    terms: np.ndarray
    answer_at: int  # number of terms in the question


def read_item(item_id: int | None, text: str, number: int = 0) -> Item:
    data = text.encode()
    found = terms(text)
    mark = data.rfind(b"?")
    at = int((word_bounds(data, BETWEEN)[0] < mark).sum()) if mark >= 0 else 0
    if not 0 < at < len(found):
        at = len(found) - max(1, len(found) // 4)
    return Item((number,) if item_id is None else item_id, found, at)


def _pairs(x: np.ndarray) -> np.ndarray:
    """Neighbouring pairs, or the terms of fewer than two."""
    return x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:] if len(x) > 1 else x


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """The share of a part's neighbouring pairs that the passage has."""
    mine = _pairs(part)
    other = _pairs(passage) if len(part) > 1 else passage
    return float(np.isin(mine, other).mean()) if len(mine) else 1.0


def length_class(n: int) -> int:
    """The least power of two that is n or more, from MIN_STRIDE on."""
    return max(MIN_STRIDE, 1 << max(n - 1, 0).bit_length())


class Index:
    """Inverted index of some items; impacts are shares of the item's own score."""

    def __init__(self, items: list[Item], n_items: int, mean_terms: float, frequency: dict[int, int]):
        self.items = [x for x in items if len(x.terms)]
        self.stride = length_class(max((len(x.terms) for x in self.items), default=0))
        self.shares: list[tuple[np.ndarray, np.ndarray]] = []  # each item's terms and their impacts
        postings: dict[int, list[tuple[int, float]]] = {}
        for number, item in enumerate(self.items):
            values, counts = np.unique(item.terms, return_counts=True)
            n = np.array([frequency[int(v)] for v in values], float)
            weight = np.log1p((n_items - n + 0.5) / (n + 0.5)) * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(item.terms) / mean_terms))
            self.shares.append((values, weight / weight.sum()))
            for v, w in zip(values.tolist(), self.shares[-1][1].tolist(), strict=True):
                postings.setdefault(v, []).append((number, w))
        self.vocabulary = np.array(sorted(postings), np.uint64)
        self.lists = [np.array([n for n, _ in postings[v]]) for v in self.vocabulary.tolist()]
        self.impacts = [np.array([w for _, w in postings[v]]) for v in self.vocabulary.tolist()]
        self.blocks = [np.maximum.reduceat(w, np.arange(0, len(w), BLOCK_POSTINGS)) for w in self.impacts]
        self.greatest = np.array([w.max() for w in self.impacts])
        self._set_bounds()

    def _set_bounds(self) -> None:
        size = max(BLOCK_ITEMS, -(-len(self.items) * len(self.lists) // TABLE_CELLS))
        self.bounds = np.zeros((len(self.lists), -(-len(self.items) // size)), np.float32)
        for row, numbers, impacts in zip(self.bounds, self.lists, self.impacts, strict=True):
            np.maximum.at(row, numbers // size, impacts)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "bounds"}  # made again where it is read

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._set_bounds()

    def numbers(self, found: np.ndarray) -> np.ndarray:
        """The vocabulary's number of each term, or -1."""
        if not len(self.vocabulary):
            return np.full(len(found), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == found, at, -1)

    def search(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all (item, score) at or above the threshold, for the
        distinct term numbers ``query``."""
        least = threshold - 1e-9
        lists, impacts, blocks = self.lists, self.impacts, self.blocks
        cursors = [[int(lists[t][0]), 0, t, float(self.greatest[t])] for t in query.tolist()]
        found = []

        def move(cursor: list, item: int) -> None:
            """To the first posting at ``item`` or after it."""
            t = cursor[2]
            cursor[1] = int(np.searchsorted(lists[t], item))
            cursor[0] = int(lists[t][cursor[1]]) if cursor[1] < len(lists[t]) else len(self.items)

        while True:
            cursors = sorted(c for c in cursors if c[0] < len(self.items))
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[3]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # bounds of the blocks in which the pivot would be
            bound, following = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.items)
            for c in cursors[: pivot + 1]:
                t = c[2]
                place = c[1] if c[0] == item else int(np.searchsorted(lists[t], item))
                block = place // BLOCK_POSTINGS
                if block < len(blocks[t]):
                    bound += float(blocks[t][block])
                    after = (block + 1) * BLOCK_POSTINGS
                    following = min(following, int(lists[t][after]) if after < len(lists[t]) else len(self.items))
            if bound < least:
                target = max(following, item + 1)
                for c in cursors[: pivot + 1]:
                    move(c, target)
            elif cursors[0][0] == item:
                score = sum(float(impacts[c[2]][c[1]]) for c in cursors[: pivot + 1])
                if score >= least:
                    found.append((item, score))
                for c in cursors[: pivot + 1]:
                    move(c, item + 1)
            else:
                for c in cursors[: pivot + 1]:
                    if c[0] < item:
                        move(c, item)


def verified(index: Index, number: int, passage: np.ndarray, threshold: float, question: float, answer: float) -> float:
    """The item's best score of a span of the passage that has its question and
    its answer, or 0."""
    item, (values, shares) = index.items[number], index.shares[number]
    own, best = max(MIN_SPAN, len(item.terms)), 0.0
    for a in range(0, max(1, len(passage) - own), own):
        span = passage[a : a + 2 * own]
        score = float(shares[np.isin(values, span)].sum())
        if score > best and score >= threshold - 1e-9 and overlap(item.terms[: item.answer_at], span) >= question and overlap(item.terms[item.answer_at :], span) >= answer:
            best = score
    return best


def leaks(index: Index, group: list[np.ndarray], threshold: float = THRESHOLD, question: float = QUESTION_SHARE, answer: float = ANSWER_SHARE) -> list[dict[int | tuple[int], float]]:
    """For each text (its terms), the verified items' keys and best scores."""
    out: list[dict[int | tuple[int], float]] = [{} for _ in group]
    stride = index.stride
    for text, found in enumerate(group):
        numbers = index.numbers(found)
        weights = np.where(numbers >= 0, index.greatest[numbers], 0.0) if len(index.greatest) else np.zeros(len(found))
        total = np.concatenate([[0.0], np.cumsum(weights)])
        starts = np.arange(0, max(1, len(found) - stride), stride)
        ends = np.minimum(starts + 2 * stride, len(found))
        for i in np.flatnonzero(total[ends] - total[starts] >= threshold - 1e-6).tolist():
            a, b = starts[i], ends[i]
            query = np.unique(numbers[a:b][numbers[a:b] >= 0])
            if index.bounds[query].sum(axis=0).max() < threshold - 1e-4:
                continue
            for number, _ in index.search(query, threshold):
                score = verified(index, number, found[a:b], threshold, question, answer)
                if score:
                    key = index.items[number].key
                    out[text][key] = max(score, out[text].get(key, 0.0))
    return out


def _cut(rows: Iterator) -> Iterator[list]:
    """Lists of (item_id, text) rows of at most SHARD_BYTES, or of one row."""
    part, size = [], 0
    for r in rows:
        n = len(r.text.encode())
        if part and size + n > SHARD_BYTES:
            yield part
            part, size = [], 0
        part.append(r)
        size += n
    if part:
        yield part


def _shards(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[Index]]:
    """For each shard of items, an index for each of their length classes."""
    items = texts(benchmark, id_col, text_col).select(F.col("doc_id").alias("item_id"), "text")

    def count(batches):
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column("text")]
            lists = [pa.array(np.unique(x).view(np.int64)) for x in found]
            yield pa.RecordBatch.from_pydict({"n_terms": pa.array([len(x) for x in found], pa.int64()), "terms": pa.array([x.to_pylist() for x in lists], pa.list_(pa.int64()))})

    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counted = map_arrow(items.select("text"), count, "n_terms long, terms array<long>").filter("n_terms > 0")
    n_items, mean_terms = counted.agg(F.count(F.lit(1)), F.avg("n_terms")).first()
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    if total > SHARD_BYTES:
        frequency = materialize(frequency, "benchmark-terms")  # read for each shard
    before = 0
    for rows in _cut(items.toLocalIterator()):
        read = [read_item(r.item_id, r.text, before + i) for i, r in enumerate(rows)]
        before += len(rows)
        mine = {int(v) for x in read for v in x.terms}
        if total > SHARD_BYTES:
            wanted = frequency.sparkSession.createDataFrame([(v - (1 << 64) if v >= 1 << 63 else v,) for v in mine], "term long")
            pairs = frequency.join(wanted, "term").collect()
        else:
            pairs = frequency.collect()
        if mine:
            counts = {r.term % (1 << 64): r.n for r in pairs}
            classes: dict[int, list[Item]] = {}
            for x in read:
                if len(x.terms):
                    classes.setdefault(length_class(len(x.terms)), []).append(x)
            yield [Index(classes[n], n_items, mean_terms, counts) for n in sorted(classes)]


def _write(shard: list[Index], folder: str) -> str:
    with create(folder, "shard") as (uri, out):
        out.write(pickle.dumps(shard))
    return uri


def _read(uri: str) -> list[Index]:
    with open_shared(uri) as f:
        return pickle.loads(f.read())


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    question: float = QUESTION_SHARE,
    answer: float = ANSWER_SHARE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, text, n_items, item_ids, best_score, contaminated) of each row,
    and the columns ``keep``."""
    rows = texts(df, id_col, text_col, keep)
    more, schema = carried(rows)
    folder = shared_folder(df.sparkSession, "benchmark")
    files = [_write(shard, folder) for shard in _shards(benchmark, item_id_col, item_text_col)]

    def search(batches):
        shard, held = [], None
        for batch in batches:
            column, found = batch.column("text"), []
            for a, b in by_bytes(column, GROUP_BYTES * min(max(len(files), 1), LARGER_GROUPS)):
                group = [terms(t.as_py()) for t in column.slice(a, b - a)]
                best: list[dict[int | tuple[int], float]] = [{} for _ in group]
                for uri in files:
                    if uri != held:
                        shard = index = None  # before the next is read
                        shard, held = _read(uri), uri
                    for index in shard:
                        for mine, more_found in zip(best, leaks(index, group, threshold, question, answer), strict=True):
                            for key, score in more_found.items():
                                mine[key] = max(score, mine.get(key, 0.0))
                found += best
            carry = {c: batch.column(c) for c in ("doc_id", "text", *more)}
            ids = [sorted(k for k in x if not isinstance(k, tuple)) for x in found]
            yield pa.RecordBatch.from_pydict(carry | {"n_items": pa.array([len(x) for x in found], pa.int64()), "item_ids": pa.array(ids, pa.list_(pa.int64())), "best_score": pa.array([max(x.values(), default=0.0) for x in found], pa.float64())})

    rows = map_arrow(rows, search, f"doc_id long, text string{schema}, n_items long, item_ids array<long>, best_score double")
    return unpacked(rows.select("doc_id", "text", *more, "n_items", "item_ids", "best_score", (F.col("n_items") > 0).alias("contaminated")))
