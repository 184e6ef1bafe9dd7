"""Conversation repair against a search over all edits, in one part and in many, and its defined results for odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from functools import cache
from itertools import groupby

import pytest

from quillmill.llm import repair

WHITE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    """With columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, name string")


def legal(roles):
    roles = roles[1:] if roles[:1] == "s" and len(roles) > 1 else roles
    return roles == "ua" * (len(roles) // 2)


def brute_edits(rows, faults):
    """All edits with at most as many insertions as could pay, by recursion over rows; no grammar, no chart."""
    most = len(rows) + 2

    @cache
    def ways(i, roles):  # cheapest (cost, audit) from row i on, given the roles so far
        out = [(0, "")] if i == len(rows) and legal(roles) else []
        if len(roles) < most:
            out += [(5 + c, "I" + a) for r in "ua" if may(roles + r) for c, a in [ways(i, roles + r)] if c < 10**6]
        if i < len(rows):
            c, a = ways(i + 1, roles)
            out.append((2 + c, "D" + a))
            if faults[i] not in ("blank", "duplicate"):
                late = 5 if faults[i] == "truncated" else 0
                own = rows[i][1][:1]
                if own and may(roles + own):
                    c, a = ways(i + 1, roles + own)
                    out.append((late + c, "K" + a))
                for r in "ua":
                    if may(roles + r):
                        c, a = ways(i + 1, roles + r)
                        out.append((late + 1 + c, "R" + a))
        return min(out, default=(10**6, ""))

    def may(roles):
        rest = roles[1:] if roles[0] == "s" else roles
        return rest == ("ua" * len(rest))[: len(rest)]

    return ways(0, "")


def brute(rows):
    """By conversation what digest() returns, of damaged rows (conv_id, turn, role, text)."""
    out = {}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r, x))
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), []
        for _, role, x in own:
            bare = x.strip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (role, x) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, x))
        cost, audit = brute_edits([(t, r) for t, r, _ in own], faults)
        n, left, lines = len(audit) - audit.count("D"), iter(own), []
        for letter in audit:
            _, role, x = (None, "", "") if letter == "I" else next(left)
            if letter != "D":
                at = len(lines) - n % 2
                lines.append(f"{role if letter == 'K' else 'user' if at % 2 == 0 else 'assistant'}:{x}")
        turns = {t for t, _, _ in own} - {None}
        count = Counter(faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def brute_damage(rows):
    for conv, turn, role, x in rows:
        space = lambda v: " " if v is None else v
        luck = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, x = space(role), space(x)
        x = "" if luck == 1 else x.translate({ord(c): None for c in ".!?"}) if luck == 2 else x
        yield from [(conv, turn, "user" if luck == 4 else role, x)] * (0 if luck == 0 else 2 if luck == 3 else 1)


def conversations(rng, n, longest=9):
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "Unknown", None])
            rows.append((conv, turn * rng.choice([1, 1, 2]) if rng.random() > 0.1 else None, role, rng.choice(["Yes.", "No!", "Why?", "cut off", "cut off é", " \t", "", None, "e.g. this one. ", "日本。"])))
    # of one turn each row once, so that their order is told
    return [next(g) for _, g in groupby(sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)), key=lambda r: r[:2])]


def got(df):
    out = {}
    for r in df.collect():
        assert r["conv_id"] not in out
        out[r["conv_id"]] = tuple(r)[1:]
    return out


@pytest.mark.parametrize("limits", [{}, {"long_rows": 2, "segment": 2}, {"long_rows": 4, "segment": 1}, {"long_bytes": 12, "segment": 3}])
def test_repair_is_brute_force(spark, limits):
    rows = conversations(random.Random(12), 120)
    want = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in rows} | brute(list(brute_damage(rows)))
    assert got(repair.digest(*repair.parts(repair.damaged(frame(spark, rows)), **limits))) == want


def test_turns_are_what_is_hashed(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "tool", "Hm."), (1, 2, "user", "cut"), (1, 3, "user", "Well?"), (2, None, None, None), (None, 5, "assistant", "Alone!")]
    for limits in ({}, {"long_rows": 1, "segment": 1}):
        out = defaultdict(list)
        for r in repair.repair(frame(spark, rows), **limits).orderBy("conv_id", "part").collect():
            out[r["conv_id"]] += [(t["role"], t["text"]) for t in r["turns"]]
        assert out == {1: [("user", "Hello."), ("assistant", "Well?")], 2: [], None: []}  # of KDDR and KRDD the first


@pytest.mark.parametrize("limits", [{}, {"long_rows": 50, "segment": 16}])
def test_one_long_conversation_among_others(spark, limits):
    """A conversation with most of all rows, a third of them one and the same."""
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant"]), "Same." if t % 3 == 0 else f"Line {t}{rng.choice(['.', ''])}") for t in range(900)] + conversations(rng, 5)
    want = brute_long(rows, 7)
    assert got(repair.digest(*repair.parts(repair.damaged(frame(spark, rows)), **limits)))[7] == want


def brute_long(rows, conv):
    """By dynamic programming over (rows read, roles so far told by their state), audits whole."""
    own = sorted((r for r in brute_damage(rows) if r[0] == conv), key=lambda r: r[1])
    seen, faults = set(), []
    for _, _, role, x in own:
        faults.append("blank" if not x.strip(WHITE) else "duplicate" if (role, x) in seen else "truncated" if x.strip(WHITE)[-1] not in ".!?" else None)
        seen.add((role, x))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "")}

    def grow(best):
        for _ in range(3):
            for (state, role), new in step.items():
                if role != "s" and state in best:
                    best[new] = min(best.get(new, (10**9, "")), (best[state][0] + 5, best[state][1] + "I"))
        return best

    best = grow(best)
    for (_, _, role, _), fault in zip(own, faults, strict=True):
        new = {s: (c + 2, a + "D") for s, (c, a) in best.items()}
        if fault not in ("blank", "duplicate"):
            for (state, r), to in step.items():
                if state in best and (r == role[:1] or r != "s"):
                    c, a = best[state]
                    new[to] = min(new.get(to, (10**9, "")), (c + (fault == "truncated") * 5 + (r != role[:1]), a + ("K" if r == role[:1] else "R")))
        best = grow(new)
    cost, audit = min(best[s] for s in ("", "a") if s in best)
    n, left, lines = len(audit) - audit.count("D"), iter(own), []
    for letter in audit:
        _, _, role, x = (0, 0, "", "") if letter == "I" else next(left)
        if letter != "D":
            lines.append(f"{role if letter == 'K' else 'user' if (len(lines) - n % 2) % 2 == 0 else 'assistant'}:{x}")
    turns, count = {r[1] for r in own}, Counter(faults)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
    return (max(turns) - min(turns) + 1 - len(turns), count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_odd_tables(spark):
    one = lambda rows: got(repair.digest(*repair.parts(repair.damaged(frame(spark, rows)))))
    assert one([]) == {}
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert one([(dropped, 0, "user", "Gone.")]) == {dropped: nothing}
    assert got(repair.digest(*repair.parts(repair.damaged(frame(spark, [(dropped, 0, "user", "Gone.")] * 3)), long_rows=2))) == {dropped: nothing}
    rows = [(None, None, None, None), (5, 3, "user", "Twice."), (5, 3, "user", "Twice."), (5, -3, "user", "é" * 100_000 + ".")]
    assert one(rows) == brute(list(brute_damage(rows)))
