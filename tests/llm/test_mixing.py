"""Operator 11 against brute force: a sort of all documents by hash."""

import hashlib
import random
import re

import pytest
from starloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, h string, _t int"


def brute(rows, weights=(5, 2, 1), budget=1.5, most=2):
    """Rows (doc_id, text, source) -> sorted (doc_id, source, size, source_size, target, taken)."""
    docs = []
    for i, text, source in rows:
        inner = hashlib.md5((text or "").encode()).hexdigest()
        h = int(hashlib.md5(f"{'' if i is None else i}:{inner}".encode()).hexdigest()[:15], 16)
        docs.append((i, source, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), h))
    names = sorted({d[1] for d in docs}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(d[2] for d in docs if d[1] == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, [*names], budget * sum(size.values())
    while free:
        share = left / sum(weight[s] for s in free)
        above = [s for s in free if share * weight[s] > most * size[s]]
        if not above:
            target |= {s: share * weight[s] for s in free}
            break
        for s in above:
            target[s] = float(most * size[s])
            free.remove(s)
            left -= target[s]
    out, seen = [], dict.fromkeys(names, 0)
    for i, s, n, _ in sorted(docs, key=lambda d: (d[3], d[2], d[0] is not None, d[0] or 0)):
        full = min(most, int(target[s] // size[s])) if size[s] else 0
        more = 2 * seen[s] + n <= 2 * (target[s] - full * size[s])
        out.append((i, s, n, size[s], target[s], min(most, full + more) * n if n else 0))
        seen[s] += n
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def got(spark, rows, **options):
    table = spark.createDataFrame([(i, t, s, "clash", 1) for i, t, s in rows], SCHEMA)
    return ordered((r.doc_id, r.source, r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(table, **options).collect())


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4] and x[5] == y[5] and x[4] == pytest.approx(y[4], rel=1e-12)


def sample(seed, n, names):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 3, 20, 300]), rng.choice(names)) for i in range(n)]
    return [*rows, (None, None, None), (None, "a b", names[0]), (3, "", names[-1]), rows[5], rows[5], (7, "z\x0bz \xa0 " * 5000, names[0])]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = sample(seed, 400, ["b", "a", "é", "Z", None, "😀", "～"])
    same(got(spark, rows), brute(rows))


def test_other_weights_and_budgets(spark):
    rows = sample(3, 200, ["x", "y", "z"])
    same(got(spark, rows, weights=(1, 7), budget=0.3, most=1), brute(rows, (1, 7), 0.3, 1))
    same(got(spark, rows, weights=(1,), budget=2.4, most=3), brute(rows, (1,), 2.4, 3))


@pytest.mark.parametrize("block", [4096, 7])
def test_tied_rows_share_the_budget(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = [(None, "one two three", "a")] * 100 + [(i, "w " * 9, "b") for i in range(60)] + [(1, "q", "c")] * 3
    out = got(spark, rows)
    same(out, brute(rows))
    for s in "abc":
        mine = [r for r in out if r[1] == s]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= max(r[2] for r in mine)


def test_sources_come_near_their_targets_on_every_layout(spark):
    rows = sample(4, 500, ["a", "b", "c", "d"])
    first = got(spark, rows)
    random.Random(5).shuffle(rows)
    assert got(spark, rows) == first
    for s in {r[1] for r in first}:
        mine = [r for r in first if r[1] == s]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= max(r[2] for r in mine)
        assert all(r[5] <= 2 * r[2] for r in mine)


def test_the_mix_repeats_rows_and_carries_columns(spark):
    table = spark.createDataFrame([(i, "a b c", "s", i % 5) for i in range(50)], "doc_id long, text string, source string, lang int")
    rows = mixing.mix(table, keep=("lang", "text"))
    mix = mixing.mixed(rows).collect()
    assert len(mix) == 75 and {r.text for r in mix} == {"a b c"} and all(r.lang == r.doc_id % 5 for r in mix)
    assert max(r["copy"] for r in mix) == 2
    with pytest.raises(ValueError):
        mixing.mix(table.withColumn("taken", table.lang), keep=("taken",))


def test_many_sources_are_numbered_side_by_side(spark):
    names = spark.range(5000).selectExpr("cast(id as string) as source").union(spark.sql("select cast(null as string)"))
    got = {r.source: r["rank"] for r in mixing.in_order(names).collect()}
    want = sorted((str(i) for i in range(5000))) + [None]
    assert got == {s: k for k, s in enumerate(want)}


def test_no_rows_and_no_words(spark):
    assert got(spark, []) == []
    same(got(spark, [(1, None, "a"), (2, "", None)]), [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)])
