"""SimHash near-dedup (operator 8): meet-in-the-middle ball hashing.

A fingerprint has one bit for each of the 64 bits of its shingles' XXH64,
set if over half of the shingles (repeats included) have it.

Fingerprints at ``RADIUS`` = 3 bits or fewer meet in the middle: the 64 bits
are cut into ``BLOCKS`` blocks, and for each block every fingerprint emits, with
that block masked out, all variants within half the radius, 1 bit, of the rest.
Of 3 differing bits at least one lies in some block; under that block's mask at
most 2 differ, and two fingerprints at 2 bits have a variant in common. (Whole
64-bit balls of half the radius would only meet at 2 bits, and balls of radius
2 have 2,081 variants against the 131 here.) Distinct fingerprints are shuffled
on their variants, colliding pairs are verified, and a task returns its links
as stars, at most one row a fingerprint, whatever a variant's share. A variant
with many fingerprints is searched by the flips of its masked bits, in time
linear in their number, not by pairs.

The classes come from connected components over distinct fingerprints, so
copies and equal fingerprints are one node. Edge cases: a text without words
has the fingerprint zero, linked like any other; null ids stay and are no
representative unless all of a class are null; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, materialize, texts
from starloom.llm.components import components, local_stars

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BLOCKS = ((0, 21), (21, 42), (42, 64))
#: Fingerprints for each bucket of variants (131 of 9 bytes each).
BUCKET_FINGERPRINTS = 50_000
#: Fingerprints of one variant that are compared pair by pair.
PAIRWISE = 256


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, bits long, content long) of each row; ``content``: a hash of the text."""

    def compute(batches):
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64)), batch.column("content")], ["doc_id", "bits", "content"])

    rows = texts(df, id_col, text_col).withColumn("content", F.xxhash64("text"))
    return map_arrow(rows, compute, "doc_id long, bits long, content long")


def _flips() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits kept, bits flipped, block) of each variant; the first of a block
    flips nothing."""
    kept, flipped, block = [], [], []
    for k, (a, b) in enumerate(BLOCKS):
        rest = [i for i in range(64) if not a <= i < b]
        for flip in [0, *(1 << i for i in rest)]:
            kept.append(sum(1 << i for i in rest))
            flipped.append(flip)
            block.append(k)
    return np.array(kept, np.uint64), np.array(flipped, np.uint64), np.array(block)


KEPT, FLIPPED, BLOCK = _flips()


def variant(bits: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The variants' keys: the masked block holds the block's number instead."""
    place = np.array([a for a, _ in BLOCKS], np.uint64)[BLOCK[number]]
    return (bits & KEPT[number]) ^ FLIPPED[number] | (BLOCK[number] + 1).astype(np.uint64) << place


def _few_bits(a: int, b: int, most: int) -> np.ndarray:
    """All numbers with up to ``most`` bits set, in the places a to b."""
    return np.array([sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(a, b), n)], np.uint64)


def _links_of_many(bits: np.ndarray, number: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the fingerprints of one variant, by flips of the masked bits.
    They connect what all verified pairs would: *centres* have the variant's
    other bits, *others* differ in one of them. Two others with different flips
    differ in 2 bits there; others with the same flip are centres elsewhere."""
    a, b = BLOCKS[BLOCK[number[0]]]
    masked = np.uint64(sum(1 << i for i in range(a, b)))
    centre = FLIPPED[number] == 0
    u: list[np.ndarray] = []
    v: list[np.ndarray] = []

    def look(left, right, most):
        """Link each of ``left`` to the one of ``right`` (one for each pattern
        of masked bits, sorted) at up to ``most`` masked bits."""
        keys = right & masked
        for flip in _few_bits(a, b, most):
            want = left & masked ^ flip
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = keys[at] == want
            u.append(left[hit])
            v.append(right[at[hit]])

    c = np.sort(bits[centre])
    o = bits[~centre]
    o = o[np.argsort(o & masked, kind="stable")]
    if len(c) and radius >= 1:
        look(c, c, radius)
    if len(o):
        same = (o[1:] & masked) == (o[:-1] & masked)
        one = o[np.append(True, ~same)]  # of the others with the same masked bits
        if radius >= 2:
            u.append(o[1:][same])
            v.append(o[:-1][same])
        if radius >= 3:
            look(one, one, 1)
        if len(c) and radius >= 1:
            look(o, c, radius - 1)
    return (np.concatenate(u), np.concatenate(v)) if u else (bits[:0], bits[:0])


def links(bits: np.ndarray, number: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of the (fingerprint, number of its variant) rows that one
    task holds, as stars."""
    keys = variant(bits, number)
    order = np.lexsort((bits, keys))
    keys, bits, number = keys[order], bits[order], number[order]
    ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
    starts = np.append(0, ends[:-1]) if len(keys) else ends[:0]
    ends = ends[: len(starts)]
    u, v = [], []
    for a, b in zip(starts[ends - starts > PAIRWISE].tolist(), ends[ends - starts > PAIRWISE].tolist(), strict=True):
        x, y = _links_of_many(bits[a:b], number[a:b], radius)
        u.append(x)
        v.append(y)
    last = np.repeat(np.where(ends - starts > PAIRWISE, starts, ends), ends - starts)
    rows, step = np.arange(len(keys)), 1
    while len(rows := rows[rows + step < last[rows]]):
        near = np.bitwise_count(bits[rows] ^ bits[rows + step]) <= radius
        u.append(bits[rows[near]])
        v.append(bits[rows[near] + step])
        step += 1
    if not u:
        return bits[:0].view(np.int64), bits[:0].view(np.int64)
    u, v = np.concatenate(u), np.concatenate(v)
    near = (np.bitwise_count(u ^ v) <= radius) & (u != v)
    return local_stars(u[near].view(np.int64), v[near].view(np.int64))


def linked(bits: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints ``bits`` as all
    pairs at ``radius`` bits or fewer would."""
    if not 1 <= radius <= 3:
        raise ValueError("the variants of one flip under a masked block serve a radius of 1 to 3")
    # a task holds a bucket's variants, so buckets follow the fingerprints, whatever the setting
    buckets = max(int(bits.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bits.count() // BUCKET_FINGERPRINTS))

    def emit(batches):
        for batch in batches:
            values = batch.column("bits").to_numpy().view(np.uint64)
            for i in range(0, len(values), 8192):
                some = values[i : i + 8192]
                all_bits, number = np.repeat(some, len(KEPT)), np.tile(np.arange(len(KEPT)), len(some))
                key = variant(all_bits, number)
                bucket = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
                full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                at = [order[cuts[b] : cuts[b + 1]] for b in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([all_bits[x].tobytes() for x in at], pa.binary()), pa.array([number[x].astype(np.uint8).tobytes() for x in at], pa.binary())], ["bucket", "bits", "number"]
                )

    def verify(batches):
        both = [(b, n) for batch in batches for b, n in zip(batch.column("bits").to_pylist(), batch.column("number").to_pylist(), strict=True)]
        if both:
            u, v = links(np.frombuffer(b"".join(b for b, _ in both), "<u8"), np.frombuffer(b"".join(n for _, n in both), np.uint8), radius)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    # repeated fingerprints were dropped before; a fingerprint has a variant once
    # and the few bytes a fingerprint are dealt out first, as each becomes 131 variants
    dealt = bits.repartition(buckets, "bits")
    balls = map_arrow(dealt, emit, "bucket int, bits binary, number binary").repartitionById(buckets, "bucket")
    return map_arrow(balls, verify, "u long, v long")


def _classes(docs: DataFrame, radius: int) -> DataFrame:
    """(bits, chosen) for each distinct fingerprint of ``fingerprints`` rows;
    ``chosen``: (missing, doc_id, content) of the class's document with the
    smallest id, null ids last."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "content"))
    distinct = materialize(docs.groupBy("bits").agg(one.alias("one")), "distinct-fingerprints")
    stars = components(linked(distinct.select("bits"), radius))
    classes = distinct.join(stars, distinct.bits == stars.node, "left").select("bits", "one", F.coalesce("least", "bits").alias("class"))
    return classes.join(classes.groupBy("class").agg(F.min("one").alias("chosen")), "class").select("bits", "chosen")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: 16 hex digits, and the
    smallest id that links reach."""
    docs = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    classes = _classes(docs, radius).select(F.col("bits").alias("_bits"), F.col("chosen.doc_id").alias("component_id"))
    return docs.join(classes, docs.bits == classes._bits).select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each class the document
    with the smallest id (of rows with that id the one whose text has the least
    hash). Rows equal in id and text are one; if their other columns differ, the
    least of them by these columns stays. All columns of ``df`` are kept, whatever
    their names."""
    docs = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    chosen = _classes(docs, radius).select(F.col("chosen.doc_id").alias("i"), F.col("chosen.content").alias("h")).distinct()
    content = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = df.select(F.struct(*[F.col(f"`{x}`") for x in df.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), content.alias("content"))
    found = rows.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col("content") == F.col("h")), "left_semi")
    return found.groupBy("id", "content").agg(F.min("row").alias("row")).select("row.*")
