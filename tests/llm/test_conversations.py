"""Operator 13 against a plain dynamic programme over whole strings."""

import hashlib
import random
import re
import zlib

import pytest
from starloom.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, digest string, copies int"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out += [(conv, turn, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))


def brute(conv, rows):
    """The result row of one conversation from its rows after damage."""
    rows = ordered(rows)
    n, seen, flags = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
    for _, _, role, text in rows:
        inner = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else None
        seen.add((role, text))
        flags.append(fault)
        if fault:
            n[fault] += 1
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    best = {"": (0, "", ())}  # state -> (cost, audit, repaired)

    def put(where, state, value):
        if state not in where or value < where[state]:
            where[state] = value

    def inserts():
        for _ in range(3):
            for state, (cost, audit, kept) in list(best.items()):
                nxt = "a" if state == "u" else "u"
                put(best, nxt, (cost + 5, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[nxt], ""))))

    for (_, _, role, text), fault in zip(rows, flags, strict=True):
        inserts()
        new = {}
        for state, (cost, audit, kept) in best.items():
            put(new, state, (cost + 2, audit + "D", kept))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[:1] in legal:
                    put(new, role[:1], (cost + more, audit + "K", (*kept, (role, text))))
                nxt = "a" if state == "u" else "u"
                put(new, nxt, (cost + 1 + more, audit + "R", (*kept, ({"u": "user", "a": "assistant"}[nxt], text))))
        best.clear()
        best.update(new)
    inserts()
    cost, audit, kept = min(best[s] for s in ("", "a") if s in best)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha), kept


def want(rows, damage=True):
    after = brute_damage(rows) if damage else [(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows]
    return {conv: brute(conv, [r for r in after if r[0] == conv])[0] for conv in {r[0] for r in rows}}


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def got(spark, rows, damage=True):
    plain = cv.rows_of(table(spark, rows))
    out = cv.audits(cv.damaged(plain) if damage else plain).collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r.conv_id: tuple(r) for r in out}


def sample(seed, convs, turns):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "u", "a", "s", "", None, "User"]
    texts = ["Hi.", "yes", "No!", "  ", "", None, "why? ", "so.\n", "x\xa0", "é😀?", "a.b"]
    rows = []
    for i in range(convs):
        for t in range(rng.randint(1, turns)):
            usual = ["user", "assistant"][t % 2]
            rows.append((rng.choice([i, i, i, i, None]) if i % 9 == 0 else i, rng.choice([t, t, t, None, t + 3]), usual if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = sample(seed, 250, 12)
    assert got(spark, rows) == want(rows)
    assert got(spark, rows, damage=False) == want(rows, damage=False)


@pytest.mark.parametrize("settle", [1, 7, 256])
def test_long_conversations_settle(monkeypatch, settle):
    monkeypatch.setattr(cv, "SETTLE_ROWS", settle)
    rng = random.Random(settle)
    for n in (0, 1, 2, 40, 900):
        for p in (0.1, 0.5, 0.95):
            rows = [(0, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]) if rng.random() < p else ["user", "assistant"][t % 2], rng.choice(["", "cut", f"{t}.", f"{t}"])) for t in range(n)]
            (_, *figures, audit, sha), kept = brute(0, rows)
            emitted = []
            talk = cv.Conversation(0, lambda *e, to=emitted: to.append(e), cv.Costs())
            seen = set()
            for _, t, role, text in rows:
                inner = re.findall(r"[^\x20\x09-\x0D]", text)
                fault = "blank" if not inner else "truncated" if inner[-1] not in ".!?" else ""
                talk.feed(t, role, text, fault, (role, text) not in seen)
                seen.add((role, text))
            assert talk.finish() == (0, *figures, audit, sha)
            assert [(e[3], e[4]) for e in emitted if e[1] != "D"] == [*kept] and "".join(e[1] for e in emitted) == audit


def test_a_settled_conversation_holds_little():
    talk = cv.Audit(lambda *e: None)
    for t in range(20000):
        talk.feed(t, ["user", "assistant", "tool"][t % 3], f"{t}.", False, t % 11 == 0)
    assert len(talk.rows) < 2 * cv.SETTLE_ROWS and len(talk.edit) < 10 * cv.SETTLE_ROWS


def test_equal_hashes_change_nothing(monkeypatch):
    """With a tiny modulus most hashes are equal by chance."""
    rng = random.Random(3)
    rows = [(0, t, rng.choice(["user", "assistant", "tool"]), f"{t}" + "." * rng.randint(0, 1)) for t in range(300)]
    monkeypatch.setattr(cv.Audit, "MODULUS", 5)
    talk = cv.Conversation(0, None, cv.Costs())
    for _, t, role, text in rows:
        talk.feed(t, role, text, "" if text[-1] == "." else "truncated", True)
    assert talk.finish() == brute(0, rows)[0]


def test_odd_tables(spark):
    assert got(spark, []) == {}
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    rows = [(9, dropped, "user", "Hello."), (8, 1, "user", "x" * 300_000 + "."), (8, 2, "assistant", "y."), (None, None, None, None), (7, -(2**63), "user", "a."), (7, 2**63 - 1, "assistant", "b.")]
    out = got(spark, rows)
    assert out[9] == (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    del out[7]
    assert out == {k: v for k, v in want(rows).items() if k != 7}
    assert got(spark, [r for r in rows if r[0] == 7], damage=False)[7][1] == 2**63 - 1


def test_repaired_rows(spark):
    rows = sample(5, 60, 10)
    out = cv.repaired(cv.rows_of(table(spark, rows))).collect()
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in out if r.conv_id == conv), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, len(mine) + 1))
        kept = brute(conv, [(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows if a == conv])[1]
        assert [(r.role, r.text) for r in mine] == [*kept]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in mine))
