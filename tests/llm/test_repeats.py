"""Operators 1 and 6 against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fixtures import docs  # noqa: F401
from starloom.llm import anchors, repeats, suffix_array, suffix_trees


def brute_bytes(rows, window):
    """Per (doc_id, text): what operator 1 returns, by a set of seen strings."""
    seen, out = set(), {}
    for key in sorted({(i is not None, i or 0, t or "") for i, t in rows}):
        data = key[2].encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - window + 1):
            if data[s : s + window] in seen:
                gone[s : s + window] = True
            seen.add(data[s : s + window])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out[key] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, window):
    seen, out = {}, {}
    for key in sorted({(i is not None, i or 0, t or "") for i, t in rows}):
        words = key[2].encode().split()
        gone = np.zeros(len(words), bool)
        for s in range(len(words) - window + 1):
            first = seen.setdefault(tuple(words[s : s + window]), key[:2])
            if first != key[:2]:
                gone[s : s + window] = True
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[key] = (len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def sample(seed, words=("ab", "b", "ccc", "dé", "e\n", "x")):
    """Texts with repeats of all kinds: copies, shared and overlapping runs,
    runs of one symbol, nulls, empty texts, repeated and null ids."""
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(40) for _ in range(3)]
    rows = [(i, " ".join(rng.choice([text(rng.randint(0, 30)), rng.choice(shared), rng.choice(shared)[5:90], "zz " * rng.randint(1, 40)]) for _ in range(rng.randint(1, 4)))) for i in range(30)]
    rows += [(40, rows[3][1]), (41, rows[4][1]), (41, rows[4][1]), (42, None), (43, ""), (5, rows[6][1]), (None, rows[7][1]), (None, shared[0]), (44, " \n ")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_brute_force(docs, seed):
    rows = sample(seed)
    want = brute_bytes(rows, 20)
    got = suffix_array.remove_repeats(docs(rows), window=20, gram=6, with_text=True).collect()
    assert len(got) == len(rows)
    left = sorted(((r.doc_id is not None, r.doc_id or 0), tuple(r)[1:5]) for r in got)
    assert left == sorted(((i is not None, i or 0), want[(i is not None, i or 0, t or "")]) for i, t in rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_brute_force(docs, seed):
    rows = sample(seed)
    want = brute_words(rows, 10)
    got = suffix_trees.remove_repeats(docs(rows), window=10, gram=4, with_text=True).collect()
    left = sorted(((r.doc_id is not None, r.doc_id or 0), tuple(r)[1:4]) for r in got)
    assert left == sorted(((i is not None, i or 0), want[(i is not None, i or 0, t or "")]) for i, t in rows)
    assert all(hashlib.sha256(b" ".join(r.kept.encode().split())).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("group_bytes", [8 << 20, 1])
def test_repeated_rows_keep_their_first_text(docs, monkeypatch, group_bytes):
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)  # all rows in one group, or each in its own
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("abcdefgh ") for _ in range(150))
    twice, nameless = text(), text()
    rows = [(1, text()), (5, twice), (5, twice), (None, nameless), (None, nameless), (9, "x" + twice + "y"), (10, nameless)]
    want = brute_bytes(rows, 20)
    got = suffix_array.remove_repeats(docs(rows).coalesce(1), window=20, gram=6).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), tuple(r)[1:]) for r in got) == sorted(((i is not None, i or 0), want[(i is not None, i or 0, t)]) for i, t in rows)
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 5: 0, None: 0, 9: 150, 10: 150}


def test_more_buckets_give_the_same(docs, monkeypatch):
    rows = sample(4)
    want = sorted(map(str, suffix_array.remove_repeats(docs(rows), window=20, gram=6).collect()))
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 200)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 500)
    assert sorted(map(str, suffix_array.remove_repeats(docs(rows), window=20, gram=6).collect())) == want


def test_empty_table_and_clashing_columns(spark, docs):
    empty = docs([])
    assert suffix_array.remove_repeats(empty).collect() == [] and suffix_trees.remove_repeats(empty).collect() == []
    odd = spark.createDataFrame([(1, "a " * 80, 7, "x", 1), (2, "a " * 80, 8, "y", 2)], "doc_id long, text string, key int, spans string, n_words int")
    assert {r.doc_id: r.n_removed for r in suffix_trees.remove_repeats(odd).collect()} == {1: 0, 2: 80}
    kept = suffix_trees.remove_repeats(odd, keep=("key", "spans")).collect()
    assert {(r.doc_id, r.key, r.spans) for r in kept} == {(1, 7, "x"), (2, 8, "y")}


def test_all_occurrences_are_listed(docs):
    passage = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, "xx " + passage + " one"), (2, "yyy " + passage + " two"), (3, "nothing"), (4, "z" + passage + "!")]
    found = suffix_array.repeat_groups(docs(rows), window=20, gram=8).collect()
    text = {i: t.encode() for i, t in rows}
    groups = {}
    for r in found:
        groups.setdefault((r.group, r.length), set()).add((r.doc_id, text[r.doc_id][r.start : r.start + r.length]))
    assert all(len({s for _, s in g}) == 1 and len(g) > 1 for g in groups.values())
    covered = {i: np.zeros(len(t), bool) for i, t in text.items()}
    for r in found:
        covered[r.doc_id][r.start : r.start + r.length] = True
    assert all(covered[i].sum() >= len(passage) for i in (1, 2, 4)) and not covered[3].any()


def brute_maximal(symbols, firsts, window):
    """Maximal repeats of the segments: left- and right-diverse substrings."""
    ends = [*firsts[1:], len(symbols)]
    found = {}
    for a, b in zip(firsts, ends, strict=True):
        for i in range(a, b):
            for n in range(window, b - i + 1):
                found.setdefault(tuple(symbols[i : i + n]), []).append((i, a, b))
    out = set()
    for s, places in found.items():
        left = {symbols[i - 1] if i > a else ("start", i) for i, a, b in places}
        right = {symbols[i + len(s)] if i + len(s) < b else ("end", i) for i, a, b in places}
        if len(places) > 1 and len(left) > 1 and len(right) > 1:
            out.add((len(s), tuple(sorted(i for i, _, _ in places))))
    return out


def as_groups(group, place, length):
    out = {}
    for g, p, n in zip(group.tolist(), place.tolist(), length.tolist(), strict=True):
        out.setdefault((g, n), []).append(p)
    return {(n, tuple(sorted(p))) for (_, n), p in out.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=14), min_size=1, max_size=5), st.integers(1, 3))
def test_kernels_find_all_maximal_repeats(segments, window):
    symbols = np.concatenate([np.array(s, np.uint8) for s in segments])
    firsts = np.cumsum([0, *(len(s) for s in segments[:-1])])
    want = brute_maximal(symbols.tolist(), firsts.tolist(), window)
    # a repeat that ends with its segments on the right is also an interval
    got = as_groups(*suffix_array.maximal_repeats(symbols, firsts, window))
    assert want <= got
    for limit in (1, 3, 100):
        assert as_groups(*suffix_trees.maximal_repeats(symbols.astype(np.uint64), firsts, window, limit)) == got


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 3, 200).astype(np.uint8)
    firsts = np.array([0, 50, 90, 199])
    order, common = suffix_array.enhanced_suffix_array(symbols, firsts)
    ends = np.repeat([50, 90, 199, 200], [50, 40, 109, 1])
    suffix = lambda i: symbols[i : ends[i]].tobytes()
    assert [suffix(i) for i in order] == sorted(suffix(i) for i in range(200))
    for a, b, n in zip(order[:-1], order[1:], common[1:], strict=True):
        x, y = suffix(a), suffix(b)
        assert x[:n] == y[:n] and (len(x) == n or len(y) == n or x[n] != y[n])


def test_tree_parents():
    symbols = np.array([1, 2, 1, 2, 1, 2, 3], np.int64)
    tree = suffix_trees.subtree(symbols, 7 - np.arange(7), np.arange(7), 7, 1)
    for i, parent in enumerate(tree.parent.tolist()):
        if parent >= 0:
            assert tree.depth[parent] < tree.depth[i] and tree.first[parent] <= tree.first[i] and tree.last[i] <= tree.last[parent]
    assert (tree.parent >= 0).sum() == 2  # 1212 below 12, 212 below 2


def test_segments_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [anchors.byte_symbols(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 5, 19, 20, 400, 90)]

    def windows(s):
        return {(d, w) for d, a, e in zip(s.doc.tolist(), s.start.tolist(), s.extent.tolist(), strict=True) for w in range(a, a + e + 1)}

    whole = anchors.segments(texts, 20, 6)
    monkeypatch.setattr(anchors, "BLOCK", 64)
    cut = anchors.segments(texts, 20, 6)
    want = {(d, w) for d, t in enumerate(texts) for w in range(len(t) - 19)}
    assert windows(whole) == windows(cut) == want
    at = {(d, a + o): h for d, a, o, h in zip(whole.doc.tolist(), whole.start.tolist(), whole.offset.tolist(), whole.anchor.tolist(), strict=True)}
    assert all(at[(d, a + o)] == h for d, a, o, h in zip(cut.doc.tolist(), cut.start.tolist(), cut.offset.tolist(), cut.anchor.tolist(), strict=True))


def test_heavy_grams_change_anchors_only(docs, monkeypatch):
    rows = sample(3)
    want = {(r.doc_id, r.kept_sha256) for r in suffix_trees.remove_repeats(docs(rows), window=10, gram=4).collect()}
    monkeypatch.setattr(repeats, "_heavy", lambda d, n, unit, window, gram: np.sort(anchors.segments([anchors.word_symbols((t or "").encode()) for _, t in rows], window, gram).anchor)[::3])
    assert {(r.doc_id, r.kept_sha256) for r in suffix_trees.remove_repeats(docs(rows), window=10, gram=4).collect()} == want


def test_cut_words_keeps_white_space():
    assert suffix_trees.cut_words(b" a b\n\nc  d\te ", np.array([1]), np.array([3])) == (5, 2, b"a d e", b" a d\te ")
    assert suffix_trees.cut_words(b"", np.array([]), np.array([])) == (0, 0, b"", b"")


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=200))
def test_words_are_the_contracts(data):
    starts, ends = anchors.word_bounds(data)
    assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == data.split()
    assert len(anchors.word_symbols(data)) == len(starts)


def test_an_anchor_of_many_segments_is_split(docs, monkeypatch, tmp_path):
    monkeypatch.setattr(repeats, "_heavy", lambda *_: np.empty(0, np.uint64))
    monkeypatch.setattr(repeats, "KERNEL_SYMBOLS", 200)
    monkeypatch.setattr(repeats, "ANCHOR_SYMBOLS", 400, raising=False)

    def kernel(symbols, firsts, window):
        (tmp_path / f"{len(symbols)}-{id(symbols)}").touch()
        return suffix_array.maximal_repeats(symbols, firsts, window)

    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    copies = [text(9) + "the phrase" + text(9) for _ in range(6)]
    bodies = [text(25) + "the phrase" + text(25) for _ in range(60)] + [text(9) + rng.choice(copies) + text(9) for _ in range(40)]
    rows = list(enumerate(bodies))
    keyed = repeats.keyed(docs(rows).select("doc_id", "text"))
    found = repeats.repeats(keyed, suffix_array.BYTES, kernel, 20, 6).collect()
    gone = {i: np.zeros(len(t), bool) for i, t in rows}
    for r in found:
        gone[r.key][r.start : r.start + r.length] = True
    want = brute_bytes(rows, 20)
    assert {i: int(g.sum()) for i, g in gone.items()} == {i: want[(True, i, t)][1] for i, t in rows}
    assert max(int(p.name.split("-")[0]) for p in tmp_path.iterdir()) <= 800


def test_split_anchors_give_the_same_words(docs, monkeypatch):
    monkeypatch.setattr(repeats, "KERNEL_SYMBOLS", 20)
    monkeypatch.setattr(repeats, "ANCHOR_SYMBOLS", 30)
    rows = sample(5)
    want = brute_words(rows, 10)
    got = suffix_trees.remove_repeats(docs(rows), window=10, gram=4).collect()
    left = sorted(((r.doc_id is not None, r.doc_id or 0), tuple(r)[1:4]) for r in got)
    assert left == sorted(((i is not None, i or 0), want[(i is not None, i or 0, t or "")]) for i, t in rows)


def test_rows_without_ids_are_told_apart_by_text(docs):
    """Many rows share the null id; each text is judged on its own."""
    rng = random.Random(11)
    passage = " ".join(f"p{rng.random()}" for _ in range(60))
    rows = [(None, f"own {i} " + " ".join(str(rng.random()) for _ in range(30))) for i in range(300)] + [(None, passage), (7, passage)]
    keyed = repeats.keyed(docs(rows).select("doc_id", "text"))
    assert dict(keyed.dtypes)["tie"] == "bigint" and keyed.select("key", "tie").distinct().count() == len(rows)
    got = {(r.doc_id, r.n_words): r.n_removed for r in suffix_trees.remove_repeats(docs(rows)).collect() if r.n_removed}
    assert got == {(7, 60): 60}
