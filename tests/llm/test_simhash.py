"""Operator 8 against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from fixtures import docs  # noqa: F401
from pyspark.sql import functions as F
from starloom.llm import simhash
from starloom.llm.components import components, local_stars

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(bits, radius):
    d = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    i, j = np.nonzero(np.triu(d, 1))
    return zip(bits[i].view(np.int64).tolist(), bits[j].view(np.int64).tolist(), strict=True)


@pytest.mark.parametrize("radius", [1, 2, 3])
@pytest.mark.parametrize("pairwise", [2, 256])
def test_variants_lose_no_link(radius, pairwise, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 3, dtype=np.uint64).tolist()
    bits = set()
    for _ in range(500):
        x = centres[rng.integers(3)]
        for _ in range(rng.integers(0, 7)):
            x ^= 1 << int(rng.integers(0, 64))
        bits.add(x)
    bits = np.array(sorted(bits), np.uint64)
    n = len(simhash.KEPT)
    u, v = simhash.links(np.repeat(bits, n), np.tile(np.arange(n), len(bits)), radius)
    assert len(u) < len(bits)
    nodes = bits.view(np.int64).tolist()
    assert brute_classes(nodes, zip(u.tolist(), v.tolist(), strict=True)) == brute_classes(nodes, near(bits, radius))


def test_variant_numbers_differ_by_one_bit():
    x = np.array([0x0123456789ABCDEF], np.uint64).repeat(len(simhash.KEPT))
    keys = simhash.variant(x, np.arange(len(simhash.KEPT)))
    assert len(set(keys.tolist())) == len(simhash.KEPT) == sum(1 + 64 - (b - a) for a, b in simhash.BLOCKS)


def sample():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(6)]
    rows = []
    for i in range(120):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(t)))
    return rows + [(200, None), (201, ""), (202, " \n"), (203, "One"), (204, "one  TWO"), (3, rows[3][1]), (None, rows[5][1]), (None, None), (205, "ÀB À b")]


def test_classes_equal_brute_force(docs):
    rows = sample()
    bits = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    d = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 3
    i, j = np.nonzero(np.triu(d, 1))
    classes = brute_classes(range(len(rows)), zip(i.tolist(), j.tolist(), strict=True))
    least = {}
    for n, c in classes.items():
        if rows[n][0] is not None:
            least[c] = min(rows[n][0], least.get(c, rows[n][0]))
    want = sorted((str(rows[n][0]), f"{int(bits[n]):016x}", least.get(c)) for n, c in classes.items())
    got = simhash.near_duplicates(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.representatives(docs(rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(least.values()))


def test_rows_without_ids(docs):
    kept = simhash.representatives(docs([(None, "a b c d"), (None, "a b c d"), (None, "x y z w v u t")])).collect()
    assert sorted(r.text for r in kept) == ["a b c d", "x y z w v u t"]
    assert simhash.near_duplicates(docs([])).collect() == [] and simhash.representatives(docs([])).collect() == []


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    chain = list(range(200))
    rng.shuffle(chain)
    links = [(a, b) for a, b in zip(chain, chain[1:])] + [(1000, 1001), (1002, 1001), (5, 5)] + [(2000, 2000 + k) for k in range(1, 50)]
    got = {r.node: r.least for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {n for link in links for n in link}
    want = {n: c for n, c in brute_classes(nodes, links).items() if n != c}
    assert got == want
    u, v = local_stars(np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == want


def test_representatives_keep_columns_and_choose_fixed_rows(spark):
    rows = [(1, "a b c d e", "z"), (1, "a b c d e", "y"), (2, "a b c d e", "x"), (3, "something else is here", "w"), (None, None, "v"), (None, "", "u")]
    table = spark.createDataFrame(rows, "doc_id long, text string, _content string").withColumn("bits", F.lit(1)).withColumn("i.j", F.lit(2))
    for frame in (table, table.repartition(5, "_content")):
        got = simhash.representatives(frame)
        assert got.columns == table.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a b c d e", "y", 1, 2), (3, "something else is here", "w", 1, 2), (None, None, "v", 1, 2)], key=str)
