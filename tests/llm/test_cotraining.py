"""Operator 3: held-out accuracy on made rows."""

import random

import numpy as np
import pytest

from starloom.llm import cotraining as C


def rows(n, seed=1):
    """(doc_id, text, lang, source, quality, toxic): bad texts have signs
    after words or shout, toxic ones hold one of a few words."""
    rng = random.Random(seed)
    words = [f"w{rng.randint(0, 9)}{c}" for c in "abcdefghijklmnopqrstuvwxyz" for _ in range(8)]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        bad, toxic = rng.random() < 0.25, rng.random() < 0.2
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["nasty", "vile", "foul"])
        if bad:
            text = [t + rng.choice(["%%%", "###"]) for t in text] if rng.random() < 0.5 else [t.upper() + "!!" for t in text]
        out.append((i, " ".join(text), rng.choice(["en", "de"]), f"s{rng.randint(0, 3) + 4 * bad}", int(not bad), int(toxic)))
    return out


@pytest.fixture(scope="module")
def judged(spark):
    data = rows(900)
    frame = spark.createDataFrame([(*r[:4], len(r[1])) for r in data], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], r[4], r[5]) for r in data if r[0] < 500] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    return data, frame, labels, C.classify(frame, labels)


def test_held_out_rows(judged):
    data, _, _, result = judged
    got = {r.doc_id: r for r in result.collect()}
    assert len(got) == len(data)
    rest = [r for r in data if r[0] >= 500]
    assert np.mean([(got[r[0]].p_low_quality >= 0.5) == (r[4] == 0) for r in rest]) > 0.97
    assert np.mean([(got[r[0]].p_toxic >= 0.5) == (r[5] == 1) for r in rest]) > 0.97
    assert np.mean([got[r[0]].kept for r in rest if r[4] and not r[5]]) > 0.97


def test_pseudo_labels_help_the_other_view():
    """Few labels: the metadata view alone knows; the content view learns from it."""
    rng = random.Random(2)
    make = lambda y: [np.unique(np.array([rng.randint(100, 160) for _ in range(6)] + [y * 50 + rng.randint(1, 6)], np.uint32)), np.array([1 + y], np.uint32)]
    labelled = [(make(i % 2), i % 2) for i in range(60)]
    pool = [make(i % 2) for i in range(600)]
    test = [(make(i % 2), i % 2) for i in range(300)]

    def right(judge):
        return np.mean((judge.calibrated([s for s, _ in test])[:, 0] > 0) == np.array([y for _, y in test]))

    assert right(C.co_train(labelled, pool, most=30)) > right(C.co_train(labelled, [])) + 0.1


def test_missing_values_and_labels(spark, judged):
    _, _, labels, _ = judged
    odd = spark.createDataFrame([(1, None, None, None, 5, "x"), (None, "", "en", "s", 6, "y"), (2, "w1a " * 9, "en", "s", 7, "z"), (2, "w1a " * 9, "en", "s", 7, "z")], "doc_id long, text string, lang string, source string, kept int, p_toxic string")
    with pytest.raises(ValueError):
        C.judge(odd, {}, keep=("kept",))
    got = C.classify(odd, labels, rounds=1).collect()
    assert len(got) == 4 and all(r.kept for r in got)  # no label of one of the classes: nothing is rejected
    none = spark.createDataFrame([], labels.schema)
    assert all(r.kept for r in C.classify(odd, none).collect())
    assert C.classify(odd.limit(0), labels).collect() == []


def test_rows_carry_columns(judged):
    _, frame, labels, _ = judged
    got = C.judge(frame, C.fit(frame, labels, max_labelled=200, pseudo=20), keep=("text", "lang")).limit(3).collect()
    assert {"doc_id", "text", "lang", "kept", "p_toxic", "p_low_quality"} == set(got[0].asDict())


def probabilities(result):
    return {r.doc_id: (round(r.p_low_quality, 9), round(r.p_toxic, 9), r.kept) for r in result.collect()}


def test_foreign_labels_and_layout_change_nothing(spark, judged):
    """A hundred label rows of other documents for each own one, and rows dealt out
    in another way, leave every judgement as it is; a bounded sample too."""
    _, frame, labels, result = judged
    foreign = spark.range(1_000_000, 1_050_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    want = probabilities(result)
    assert probabilities(C.classify(frame.repartition(7, "text"), labels.unionByName(foreign))) == want
    few = probabilities(C.classify(frame, labels, max_labelled=120))
    assert probabilities(C.classify(frame.repartition(3), labels.unionByName(foreign).repartition(5), max_labelled=120)) == few
    assert sum(not k for *_, k in few.values()) > 50


def test_rounds_search_all_documents(spark, judged):
    """The surest of all tasks are those of one task that holds everything."""
    _, frame, labels, _ = judged
    found = C.materialize(C.features(frame.repartition(9)), "features")
    sample = C._sampled(found, labels, 300)
    assert sample.num_rows == 300
    sets, y = C._sets(sample), sample.column("toxic").to_pylist()
    judge = C.co_train(list(zip(sets, y, strict=True)), [])
    ids = {*sample.column("_id").to_pylist()}
    got = C._finder(found, ids, 25)(judge, set())
    rest = sorted(((r.doc_id, [np.frombuffer(r.content, np.uint32), np.frombuffer(r.metadata, np.uint32)]) for r in found.collect() if r.doc_id not in ids), key=lambda x: x[0])
    want = C.surest(judge, [s for _, s in rest], np.array([i for i, _ in rest]), 25)
    assert [(v, y, i) for v, y, i, _ in got] == [(v, y, rest[k][0]) for v, y, _, k in want] and got


def test_metadata_is_not_read_from_the_text(spark):
    rows = [(1, "some text here.", "en", "s", 10), (2, "QUITE !!! another\n\none 77", "en", "s", 10)]
    found = C.features(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).orderBy("doc_id").collect()
    assert found[0].metadata == found[1].metadata and found[0].content != found[1].content


def test_regression_by_newton():
    x = np.linspace(-3, 3, 200)
    y = (np.random.default_rng(0).random(200) < C.sigmoid(2 * x - 1)).astype(float)
    w = C.logistic(x[:, None], y)
    g = np.column_stack([x, np.ones(200)]).T @ (C.sigmoid(w[0] * x + w[1]) - y)
    assert np.abs(g + 1e-3 * w).max() < 1e-6
