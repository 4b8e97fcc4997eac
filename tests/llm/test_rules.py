"""Operator 5 against brute force."""

import random
import re
from collections import Counter

from fixtures import docs  # noqa: F401
from starloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def sample():
    rng = random.Random(2)
    words = ["the", "of", "und", "là", "😀x", "a#b", "*", "Is", "tion", "que", "<p>"]
    text = lambda n, k: "".join(rng.choice(words[:k]) + rng.choice([" ", " ", "  ", "\n", "\t", "\n\n", "\x0b", "\xa0"]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 150), rng.randint(2, len(words)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "\n \n"), (503, "one"), (504, "one two"), (505, "a a a"), (506, "a a a a"), (None, "the of and to is a"), (3, rows[4][1]), (507, "the of and line\n" * 4000)]


def test_base_figures_equal_brute_force(docs):
    rows = sample()
    got = rules.quality_rules(docs(rows)).collect()
    key = lambda i: (i is not None, i or 0)
    have = sorted((key(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == sorted((key(i), *brute(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_judge(docs):
    clean = " ".join(f"word{i} the of w{i}" for i in range(40))
    rows = [(1, clean), (2, clean.replace("the", "#x#")), (3, clean.replace("the", "zz").replace("of", "yy")), (4, clean.upper().replace(" ", "!! ")), (5, "\n".join(["the same of line"] * 9 + [clean]))]
    assert {r.doc_id: r.kept for r in rules.quality_rules(docs(rows)).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_no_rows_and_clashing_columns(spark, docs):
    assert rules.quality_rules(docs([])).collect() == []
    odd = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_words int, _words string")
    assert rules.quality_rules(odd).first().n_words == 2


def test_plan_is_native(docs):
    plan = rules.quality_rules(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
