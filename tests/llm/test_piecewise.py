"""Piecewise fingerprints against a plain loop, and their defined results for odd rows."""

import hashlib
import random
from collections import Counter

import pytest

from quillmill.llm import piecewise

from .test_operators import ODD, docs_of, text

ODD_INT, FULL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def brute_print(t: bytes) -> str:
    padded, hashes = bytes(7) + t, []
    for i in range(len(t)):
        h = int.from_bytes(padded[i : i + 8], "little") * ODD_INT & FULL
        hashes.append((h ^ h >> 32) * ODD_INT & FULL)
    level = 0
    while sum(h < 1 << 64 - level for h in hashes) >= 64:
        level += 1

    def sign(k):
        out, part = "", []
        for i, h in enumerate(hashes):
            part.append(h)
            if h < 1 << 64 - k or i == len(hashes) - 1:
                v = (sum(part) * ODD_INT & FULL) >> 52
                out, part = out + piecewise.LETTERS[v >> 6] + piecewise.LETTERS[v & 63], []
        return out

    return f"{level}:{sign(level)}:{sign(level + 1)}" if t else "0::"


def brute_distance(a, b):
    """Chunks put in or taken out to make b of a."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    cut = lambda s: [s[k : k + 2] for k in range(0, len(s), 2)]
    levels = [{int(p[0]): cut(p[1]), int(p[0]) + 1: cut(p[2])} for p in (a.split(":"), b.split(":"))]
    both = [(levels[0][k], levels[1][k]) for k in levels[0] if k in levels[1] and levels[0][k] and levels[1][k]]
    return max((1 - brute_distance(x, y) / (len(x) + len(y)) for x, y in both), default=0.0)


def brute(rows):
    out = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        own, changed = brute_print(t.encode()), brute_print(new.encode())
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), own, changed, round(brute_likeness(own, changed), 12), round(brute_likeness(own, brute_print(after.encode())), 12)))
    return out


def got(df):
    return [(*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.select(*piecewise.NAMES).collect()]


def test_neighbours_are_brute_force(spark):
    rng = random.Random(13)
    rows = [(i, text(rng, rng.choice([1, 3, 30, 300]))) for i in range(60)] + [(200 + i, "é日" * i + "x") for i in range(20)] + [r for r in ODD if r[0] != 905]
    rows += [(1000, "tea " * 40000), (-5, rows[3][1]), (-6, rows[3][1])]
    rows.sort(key=lambda r: -r[0])
    assert Counter(got(piecewise.neighbours(docs_of(spark, rows)))) == Counter(brute(rows))


def test_rows_without_order(spark):
    """Null ids last; rows of one id beside each other; a row alone; none."""
    rows = [(None, "last of all"), (7, "same text"), (7, "same text"), (9, "first of all")]
    out = got(piecewise.neighbours(docs_of(spark, rows)))
    assert Counter(out) == Counter(brute([rows[3], rows[1], rows[2], rows[0]]))
    assert got(piecewise.neighbours(docs_of(spark, [(1, None)]))) == brute([(1, "")])
    assert piecewise.neighbours(docs_of(spark, [])).count() == 0


def test_blocks_do_not_show():
    rng = random.Random(2)
    long = text(rng, 60_000).encode()
    assert len(long) > 3 * piecewise.BLOCK and piecewise.fingerprint(long) == brute_print(long)
    assert piecewise.fingerprint(b"ab" * 300_000) == brute_print(b"ab" * 300_000)


@pytest.mark.parametrize("words", [200, 2000])
def test_edits_stay_near(words):
    rng = random.Random(words)
    base = text(rng, words).split()
    for _ in range(20):
        new = list(base)
        for _ in range(3):
            new[rng.randrange(words)] = "changed"
        assert piecewise.likeness(piecewise.fingerprint(" ".join(base).encode()), piecewise.fingerprint(" ".join(new).encode())) > 0.8
        assert piecewise.likeness(piecewise.fingerprint(" ".join(base).encode()), piecewise.fingerprint(text(rng, words).encode())) < 0.3


def test_fingerprints_alone(spark):
    rows = [*ODD, (None, "x")]
    assert Counter(tuple(r) for r in piecewise.fingerprints(docs_of(spark, rows)).collect()) == Counter((i, brute_print((t or "").encode())) for i, t in rows)
