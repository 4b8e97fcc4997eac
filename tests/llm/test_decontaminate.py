"""Operator 9 against brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import Row

from fixtures import docs  # noqa: F401
from starloom.llm import decontaminate as D


def items(n, seed=1):
    rng = random.Random(seed)
    common, rare = ["the", "of", "and", "to", "in"], [f"r{i}" for i in range(400)]
    return [(i, " ".join(rng.choice(common if rng.random() < 0.4 else rare) for _ in range(rng.randint(10, 60))) + "? " + " ".join(rng.choice(rare) for _ in range(5))) for i in range(n)]


def index(rows):
    read = [D.read_item(i, t) for i, t in rows]
    frequency = Counter(int(v) for x in read for v in np.unique(x.terms))
    return D.Index(read, len(read), float(np.mean([len(x.terms) for x in read])), frequency)


def test_search_finds_all_at_the_threshold():
    ix = index(items(120))
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 120, 2)
        found = np.concatenate([ix.items[a].terms[: rng.integers(1, 60)], ix.items[b].terms[: rng.integers(1, 60)]])
        numbers = ix.numbers(found)
        query = np.unique(numbers[numbers >= 0])
        scores = np.zeros(len(ix.items))
        for t in query:
            scores[ix.lists[t]] += ix.impacts[t]
        assert (ix.bounds[query].sum(axis=0).max() >= scores.max() - 1e-4)
        for threshold in (0.05, 0.3, 0.7):
            got = dict(ix.search(query, threshold))
            assert got.keys() == set(np.flatnonzero(scores >= threshold - 1e-9).tolist())
            assert all(abs(got[i] - scores[i]) < 1e-9 for i in got)


def test_an_item_scores_one_for_itself():
    ix = index(items(30))
    for n, item in enumerate(ix.items):
        assert abs(dict(ix.search(np.unique(ix.numbers(item.terms)), 0.9))[n] - 1) < 1e-9


def corpus():
    rng = random.Random(9)
    filler = lambda n: " ".join(rng.choice(["the", "of", "and", "lorem", "ipsum", *[f"f{i}" for i in range(50)]]) for _ in range(n))
    bench = items(40, 3) + [(900, None), (901, ""), (902, "?"), (903, items(40, 3)[5][1]), (None, "no id at all here")]
    rows, truth = [], {}
    for i in range(60):
        t = filler(rng.randint(0, 400))
        if i % 3 == 0:
            n, passage = bench[rng.randrange(40)]
            if i % 2:
                passage = passage.upper().replace(" ", rng.choice([" | ", "\n", ", "]))
            t = t + " " + passage + " " + filler(rng.randint(0, 300))
            truth[i] = {n}
        elif i % 3 == 1:  # a question without its answer is no leak, nor is an answer alone
            passage = bench[rng.randrange(40)][1]
            t += " " + rng.choice(passage.split("?"))
        rows.append((i, t))
    for i, found in truth.items():
        if 5 in found:
            found.add(903)
    return rows + [(100, None), (101, ""), (None, "the of"), (0, rows[0][1])], bench, truth


def test_leaks_and_only_leaks_are_found(spark, docs, monkeypatch):
    rows, bench, truth = corpus()
    table = spark.createDataFrame(bench, "item_id long, text string")
    got = D.contamination(docs(rows), table).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: set(r.item_ids) for r in got if r.contaminated} == truth
    monkeypatch.setattr(D, "SHARD_BYTES", 1500)  # several passes, the same result
    again = D.contamination(docs(rows), table, keep=("lang",)).collect()
    assert sorted((str(r.doc_id), r.n_items, r.item_ids, round(r.best_score, 9)) for r in again) == sorted((str(r.doc_id), r.n_items, r.item_ids, round(r.best_score, 9)) for r in got)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in D.contamination(docs([(1, "a")]), none).collect()] == [False]
    assert D.contamination(docs([]), spark.createDataFrame(items(3), "item_id long, text string")).collect() == []


def test_shards_are_searched_in_one_map(spark, docs, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 1500)
    rows, bench, truth = corpus()
    table = spark.createDataFrame(bench, "item_id long, text string")
    shards = list(D._shards(table, "item_id", "text"))
    assert len(shards) > 3
    got = D.contamination(docs(rows), table)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: set(r.item_ids) for r in got.collect() if r.contaminated} == truth


def test_shards_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 100)
    rows = [Row(item_id=i, text="x" * n) for i, n in enumerate((40, 60, 1, 300, 50, 51, 49))]
    assert [[r.item_id for r in part] for part in D._cut(iter(rows))] == [[0, 1], [2], [3], [4], [5, 6]]


def test_a_long_item_does_not_widen_the_others(spark, docs, monkeypatch):
    rng = random.Random(4)
    filler = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    long = " ".join(f"l{rng.randrange(2000)}" for _ in range(3000))
    bench = [(1, "alpha beta gamma delta? omega"), (2, long), (3, " ".join(f"m{i}" for i in range(90)) + "? yes"), *items(20, 6)]
    pieces = ["alpha beta", "beta gamma", "gamma delta", "omega"]
    scattered = {10: 200, 11: 28}  # the item's pairs, so many terms apart
    rows = [(i, " ".join(f"{p} {filler(n)}" for p in pieces)) for i, n in scattered.items()]
    rows += [(12, filler(70) + " Alpha, beta gamma delta? Answer: omega " + filler(300)), (13, filler(500) + " " + long + " " + filler(40)), (14, filler(63) + " " + bench[2][1])]
    table = spark.createDataFrame(bench, "item_id long, text string")
    want = {10: set(), 11: set(), 12: {1}, 13: {2}, 14: {3}}
    got = D.contamination(docs(rows), table).collect()
    assert {r.doc_id: set(r.item_ids) for r in got} == want
    monkeypatch.setattr(D, "SHARD_BYTES", 900)
    again = D.contamination(docs(rows), table).collect()
    assert sorted((r.doc_id, r.item_ids, r.best_score) for r in again) == sorted((r.doc_id, r.item_ids, r.best_score) for r in got)


def test_items_without_id_contaminate(spark, docs, monkeypatch):
    nameless = [(None, "where do the lost items go? nowhere"), (None, "who has no name here? nobody"), (7, "who has no name here? nobody")]
    table = spark.createDataFrame(items(20, 6) + nameless, "item_id long, text string")
    rows = [(1, "so: " + nameless[0][1]), (2, nameless[0][1] + " " + nameless[1][1]), (3, "clean")]
    for size in (D.SHARD_BYTES, 40):
        monkeypatch.setattr(D, "SHARD_BYTES", size)
        got = {r.doc_id: (r.n_items, r.item_ids, r.contaminated) for r in D.contamination(docs(rows), table).collect()}
        assert got == {1: (1, [], True), 2: (3, [7], True), 3: (0, [], False)}
