"""Each operator on small tables against brute force, and its defined results for odd rows."""

import hashlib
import random
import time
import zlib
from collections import Counter
from itertools import combinations
from math import log

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmill.llm import ann, decontaminate, fixity, linededup, lm, packing, quality, simhash, tokencount, toxicity

WORDS = "the of and tea pot brown wall river stone light paper glass morning winter garden house music dance bread salt".split()
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def docs_of(spark, rows):
    """With columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, fp int, part string")


ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "Two Words"), (905, "word " * 30000), (905, "word " * 30000), (906, "é́ \xa0x 日本")]


# --- 1


def brute_print(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(prints, near):
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and near(prints[a], prints[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def test_simhash_is_brute_force(spark):
    rng = random.Random(3)
    rows = list(ODD)
    for g in range(12):
        base = text(rng, 60).split()
        for k in range(8):
            w = list(base)
            for _ in range(k // 3):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((g * 10 + k, " ".join(w)))
    got = simhash.simhash_components(docs_of(spark, rows)).collect()
    prints = {i: brute_print(t) for i, t in rows}
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == Counter((i, f"{prints[i]:016x}", roots[i]) for i, _ in rows)
    assert simhash.simhash_components(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_balls_meet_at_three(spark, distance):
    rng = random.Random(distance)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    pairs = []
    for _ in range(60):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), distance):
            b ^= 1 << bit
        pairs.append((a, b))
    df = spark.createDataFrame([(0, signed(x)) for p in pairs for x in p], "tab int, fp long")
    links = {frozenset((r["a"], r["b"])) for r in simhash.ball_links(df).collect()}
    want = {frozenset((signed(a), signed(b))) for a, b in pairs}
    assert links == want if 0 < distance <= 3 else not links


def test_long_texts_are_split_alike():
    rng = random.Random(1)
    t = text(rng, 5000).encode()
    whole = list(simhash.shingle_hashes(t, 3, 42))
    old, simhash.PIECE = simhash.PIECE, 1000
    try:
        assert list(simhash.shingle_hashes(t, 3, 42)) == whole
        assert list(simhash.shingle_hashes(b"a" * 3000, 3, 42)) == [xxhash.xxh64_intdigest(b"a" * 3000, 42)]
    finally:
        simhash.PIECE = old


def test_near_duplicates_go(spark):
    rng = random.Random(5)
    rows, kept = [], set()
    for g in range(20):
        base = text(rng, 150).split()
        rows.append((g * 10, " ".join(base)))
        kept.add(g * 10)
        for k in (1, 2):
            w = list(base)
            w[rng.randrange(len(w))] = "changed"
            rows.append((g * 10 + k, " ".join(w)))
        rows.append((g * 10 + 5, text(rng, 150)))
        kept.add(g * 10 + 5)
    rows += [(500, ""), (501, None), (502, "a b"), (503, "a b"), (0, rows[0][1])]
    out = simhash.near_dedup(docs_of(spark, rows))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(kept | {500, 501, 502})
    assert out.columns == ["doc_id", "text", "fp", "part"]


def test_near_dedup_takes_any_columns(spark):
    """Names that the operator uses itself keep their values; repeated rows stay once; an empty table stays empty."""
    names = ["doc_id", "text", "row", "key", "row_key", "alone", "_row", "id"]
    rows = [(1, "one two three four five six", *range(6)), (1, "one two three four five six", *range(6)), (2, "One two three four five six", *range(6, 12)), (3, None, *range(12, 18)), (None, "", *range(18, 24))]
    schema = "doc_id long, text string, " + ", ".join(f"{n} int" for n in names[2:])
    out = simhash.near_dedup(spark.createDataFrame(rows, schema))
    assert out.columns == names and sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], *rows[3:]], key=str)
    assert simhash.near_dedup(spark.createDataFrame([], schema)).count() == 0


def test_near_duplicates_are_brute_force(spark):
    """Pairs of a similarity between 0.7 and 0.9: none below 0.8 links, and nearly all others do."""
    rng = random.Random(9)
    rows, far, near = [], [], []
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for g in range(300):
        base = text(rng, rng.choice([60, 150, 300])).split()
        base += base[:40] * (g % 3)  # repeated shingles count once
        w = list(base)
        goal = rng.uniform(0.7, 0.9)
        while (found := len(shingles(base) & shingles(w)) / len(shingles(base) | shingles(w))) > goal:
            w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
        (near if found >= 0.8 else far).append(g)
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(w))]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert len(near) > 90 and len(far) > 90
    assert not [g for g in far if got[2 * g] == got[2 * g + 1]]
    assert sum(got[2 * g] == got[2 * g + 1] for g in near) >= 0.97 * len(near)
    assert all(v in (k, k - k % 2) for k, v in got.items())


def test_rows_without_an_id_are_documents(spark):
    """Of null ids, and of one id with several texts, what stays goes by the texts."""
    rng = random.Random(11)
    a, b, c, d = (text(rng, 80) for _ in range(4))
    rows = [(None, a), (None, b), (None, b), (None, c + " end"), (None, ""), (None, None), (1, c), (2, a + " end"), (2, d), (2, d)]
    out = [(r["doc_id"], r["text"]) for r in simhash.near_dedup(docs_of(spark, rows)).collect()]
    assert Counter(out) == Counter([(None, b), (None, ""), (None, None), (1, c), (2, a + " end"), (2, d)])
    got = decontaminate.decontaminate(docs_of(spark, rows), spark.createDataFrame([(1, b)], "item_id long, text string"))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(r for r in rows if r[1] != b)
    insult = "vile rotten " + text(rng, 20)
    docs = docs_of(spark, [(i, text(rng, 20) + (" quazzlemork" if i % 2 else "")) for i in range(200)] + [(None, insult + " quazzlemork quazzlemork"), (None, a)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    assert [r["text"] for r in toxicity.keep_clean(docs, labels).where("doc_id is null").collect()] == [a]


@pytest.mark.parametrize("first", [1, 4])
def test_failed_stars_are_bucketed_again(spark, monkeypatch, first):
    """Components of verified links equal brute force over all pairs that meet, whatever the centres and the holders of a word, and whichever tables come first."""
    monkeypatch.setattr(simhash, "FIRST_TABLES", first)
    rng = random.Random(8)
    held, kind = [], {}
    for g in range(8):
        base = rng.getrandbits(32)
        for k in range(14):
            node = g * 100 + k
            kind[node] = rng.randrange(3) if k else 3  # the least node, which stands for its word, is like no other
            held += [(t, base ^ (1 << rng.randrange(32) if k % 2 else 0), node) for t in range(2)]
    rows = spark.createDataFrame(held, "tab int, word long, node long")
    kinds = spark.createDataFrame(list(kind.items()), "node long, kind int")
    side = lambda s: kinds.select(F.col("node").alias(s), F.col("kind").alias(f"{s}_kind"))
    found = simhash.linked(rows, lambda pairs: pairs.join(side("a"), "a").join(side("b"), "b").where("a_kind = b_kind").select("a", "b"))
    nodes = {n: (k, {t: w for t, w, m in held if m == n}) for n, k in kind.items()}
    roots = brute_components(nodes, lambda a, b: a[0] == b[0] and any((a[1][t] ^ b[1][t]).bit_count() <= 2 for t in a[1]))
    size = Counter(roots.values())
    assert {r["node"]: r["root"] for r in found.collect()} == {n: r for n, r in roots.items() if size[r] > 1}


def test_crowded_near_groups_are_brute_force(spark, monkeypatch):
    """One base text in many edited copies, near the threshold of one another, and short texts: components equal those of all pairs, compared in their buckets or in rounds."""
    rng = random.Random(12)
    base = text(rng, 120).split()
    rows = []
    for k in range(160):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + str(k)
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 12)))) for k in range(200)]
    shingles = lambda t: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w := t.split()) >= 5 else {tuple(w)}
    want = brute_components({i: shingles(t) for i, t in rows}, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    for bound in (simhash.BROADCAST_BYTES, 0):
        monkeypatch.setattr(simhash, "BROADCAST_BYTES", bound)
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs_of(spark, rows)).collect()}
        assert all(want[i] == want[c] for i, c in got.items())  # nothing links that should not
        assert sum(got[i] != want[i] for i in got) <= 2 and len(set(want.values())) > 100


def test_shared_elements_are_counted_exactly():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300))).astype(np.uint64) for _ in range(40)] + [np.array([7], np.uint64)] * 2
    i, j = np.triu_indices(len(sets), 1)
    for limit in (0.3, 0.5, 1.0):
        want = [len(set(sets[a]) & set(sets[b])) >= limit * len(set(sets[a]) | set(sets[b])) - 1e-9 for a, b in zip(i, j, strict=True)]
        assert (simhash.alike(sets, i, j, limit, columns=50) == want).all()


# --- 2


def test_toxicity_learns_gapped_insults(spark):
    rng = random.Random(7)
    insults = ("blorpface", "snargle", "vixtomb")
    rows, labels = [], []
    for i in range(400):
        words = text(rng, 60).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(insults) + rng.choice(("", ".", "s")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(1000, text(rng, 30) + " sn.ar.gle and s n a r g l e " + text(rng, 30)), (1001, text(rng, 40) + " blorxpface vixxtomb " + text(rng, 20)), (1002, ""), (1003, None), (1004, text(rng, 4000)), (1004, text(rng, 4000))]
    labels_df = spark.createDataFrame([*labels, (1002, None), (None, 1)], "doc_id long, toxic int")
    got = [r.asDict() for r in toxicity.toxicity(docs_of(spark, rows), labels_df).collect()]
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [(g["predicted"], truth[g["doc_id"]]) for g in got if g["held_out"] and g["doc_id"] in truth]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.97
    by = {g["doc_id"]: g for g in got}
    assert by[1000]["predicted"] == 1 and by[1001]["predicted"] == 1
    assert [by[i]["predicted"] for i in (1002, 1003, 1004)] == [0, 0, 0]
    assert all(0 <= g["score"] <= 1 and g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 5 == 0) for g in got)
    none = toxicity.toxicity(docs_of(spark, rows[:3]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] for r in none.collect()] == [0.0] * 3


def test_toxicity_tells_insults_of_common_syllables(spark):
    """Each five letters of these insults stand in clean words as well; capitals beyond ASCII are their small letters, and unlike letters are unlike."""
    rng = random.Random(31)
    syllables = ["ach", "lich", "ein", "zu", "keit", "er", "un", "schö", "schä", "gen", "be", "ver"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5)))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(rng.randrange(40, 90))]
        words = [w for w in words if not w.startswith(("achlicheinzu", "schökeitun"))]
        if i % 4 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(("achlicheinzu", "schökeitun", "SCHÖKEITUN")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    got = toxicity.toxicity(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    hit = [r["predicted"] for r in got if r["doc_id"] % 4 == 0]
    assert len(hit) > 20 and sum(hit) / len(hit) > 0.85 and sum(r["predicted"] for r in got if r["doc_id"] % 4) / len(got) < 0.03
    one = lambda t: toxicity.sentences([t.encode()])[0].tolist()
    assert one("schön") == one("SCHÖN") != one("schän") and one("é") != one("è") and toxicity.OTHER in one("日")


def brute_sentences(t):
    """Letters of each sentence of an ASCII text, edges between words."""
    out = []
    for line in t.split("\n"):
        held = []
        for w in line.split():
            held.append([ord(c) - 96 for c in w.lower() if c.isalpha()])
            if w[-1] in ".!?" and not (len(w) == 2 and w[0].isalpha()):
                out.append(held)
                held = []
        out.append(held)
    full = [[w for w in s if w] for s in out]
    return [[31, *(c for w in s for c in (*w, 31))] for s in full if s]


def brute_kernel(window):
    """Weights of all gapped subsequences of a window, by their letters."""
    out = Counter()
    for start in range(toxicity.STARTS):
        for rest in combinations(range(start + 1, start + toxicity.SPAN), toxicity.ORDER - 1):
            at = (start, *rest)
            if at[-1] < len(window) and all(window[p] for p in at):
                out[tuple(window[p] for p in at)] += toxicity.DECAY ** (at[-1] - start + 1 - toxicity.ORDER)
    return out


def test_toxicity_values_are_brute_force(spark):
    rng, np_rng = random.Random(4), np.random.default_rng(4)
    weights = np_rng.standard_normal([toxicity.CODES] * toxicity.ORDER).astype(np.float32)
    for axis in range(toxicity.ORDER):
        weights[(slice(None),) * axis + (0,)] = 0  # no subsequence holds what stands between sentences
    weights = weights.ravel()
    number = lambda letters: sum(c * toxicity.CODES ** (toxicity.ORDER - 1 - i) for i, c in enumerate(letters))
    marks = ["", "", ".", "! ", "\n", " . ", "? x. ", "-", "'s", "\n\n", "...", " 7 "]
    rows = ["".join(rng.choice(WORDS) + rng.choice(marks) + " " for _ in range(rng.randrange(1, 40))) for _ in range(30)] + ["", " .", "7", "a", "I. d. i. o. t", "x" * 30, "\n"]
    tops, windows = toxicity.worst([r.encode() for r in rows], weights, windows=True)
    for r, got, found in zip(rows, tops, windows, strict=True):
        best = []
        for s in brute_sentences(r):
            padded = s + [0] * toxicity.WINDOW
            best.append(max(sum(float(weights[number(k)]) * v for k, v in brute_kernel(padded[p : p + toxicity.WINDOW]).items()) for p in range(len(s))))
        best = sorted(best, reverse=True)[:2]
        assert np.allclose(got[: len(best)], best, atol=1e-3) and np.isnan(got[len(best) :]).all() and len(found) == len(best)
    held = sorted({w for ws in windows for w in ws})
    x = toxicity.features(held)
    vocabulary = np.unique(x[x >= 0])
    phi = np.zeros((len(vocabulary), len(held)), np.float32)
    brute = [{number(k): v for k, v in brute_kernel(list(w)).items()} for w in held]
    for k, b in enumerate(brute):
        phi[np.searchsorted(vocabulary, list(b)), k] = list(b.values())
    want = [[sum(v * b.get(n, 0) for n, v in a.items()) for b in brute] for a in brute]
    assert np.allclose(toxicity.kernel(x, vocabulary, phi), want, rtol=1e-3)
    # The folded table gives what the machine gives on the Nystroem map.
    folded, bias = toxicity.machine(held[:20], held[20:])
    y = np.array([sum(v * folded[n] for n, v in b.items()) for b in brute]) + bias
    assert (y[:20] > 0).mean() > 0.9 and (y[20:] < 0).mean() > 0.9


def test_toxicity_takes_odd_tables(spark):
    """Empty tables, one row repeated, and very long and unbroken texts; a long text's score does not hang on where it is cut."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs_of(spark, []), labels).count() == 0
    rng = random.Random(5)
    rows = [(i, text(rng, 30) + (" quazzlemork" if i % 2 else "")) for i in range(100)] * 2
    rows += [(500, "b" * 3_000_000), (501, text(rng, 300_000) + " quazzlemork")]
    got = toxicity.toxicity(docs_of(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(r["predicted"] == r["doc_id"] % 2 for r in got)
    long_ = [rows[-1][1].encode()]
    old, toxicity.PART = toxicity.PART, 100_000
    try:
        parts, owner = toxicity.parts_of([b"", long_[0], b"x"])
        assert len(parts) > 20 and b"".join(parts) == long_[0] + b"x" and set(owner.tolist()) == {0, 1, 2}
        model = np.zeros(toxicity.CODES**toxicity.ORDER, np.float32)
        model[toxicity.features([toxicity.sentences([b"quazzlemork"])[0][:toxicity.WINDOW].tobytes()]).max()] = 1
        cut, whole = (toxicity.worst(long_, model)[0][0, 0] for toxicity.PART in (100_000, 1 << 22))
        assert cut == whole > 0
    finally:
        toxicity.PART = old


# --- 3


def brute_scores(rows, alpha=0.4):
    ws = [(i, (t or "").encode().lower().split()) for i, t in rows]
    one, two = Counter(w for _, x in ws for w in x), Counter(p for _, x in ws for p in zip(x, x[1:], strict=False))
    total, out = sum(one.values()), []
    for i, x in ws:
        s = n = 0
        for j, w in enumerate(x):
            if j and two[x[j - 1], w] >= 2:
                s += log(two[x[j - 1], w] / one[x[j - 1]])
            else:
                n += 1
                s += log(one[w] / total) + (log(alpha) if j else 0)
        out.append((i, len(x), n, round(s, 5)))
    return Counter(out)


def test_lm_scores_are_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, text(rng, rng.randrange(1, 40))) for i in range(60)] + ODD
    got = lm.scores(docs_of(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_backed_off"], round(r["log_score"], 5)) for r in got) == brute_scores(rows)
    assert lm.scores(docs_of(spark, [])).count() == 0
    assert (lm.unpack(lm.pack(np.array([1, 254, 255, 256, 70000])), 5) == [1, 254, 255, 256, 70000]).all()


# --- 4


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(11)
    long_ = ["a line of twenty chars", "ANOTHER line of many characters", "yet another line, long enough", "ß" * 20]
    rows = []
    for i in range(40):
        ls = [rng.choice([*long_, "short", "", f"own line of document {i}"]) for _ in range(rng.randrange(1, 9))]
        ls = [rng.choice(("", " ", "\t")) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) + rng.choice(("", "\r")) for x in ls]
        rows.append((i, "\n".join(ls)))
    rows += ODD
    strip = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in rows:
        for k in map(strip, (t or "").split("\n")):
            holders.setdefault(k, set()).add(i)
    want = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if len(strip(x)) < 20 or len(holders[strip(x)]) < 3 or i == max(holders[strip(x)])]
        want.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    out = linededup.drop_lines(docs_of(spark, rows))
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()) == Counter(want)
    assert linededup.drop_lines(docs_of(spark, [])).count() == 0


def test_line_dedup_takes_any_columns_and_ids(spark):
    """Clashing names, null and repeated ids, and keys that are taken by broadcast or by shuffle."""
    line = "a line of over twenty letters"
    rows = [(None, line + "\nx", 1, "a", "b", 9), (1, line, 2, "c", "d", 9), (1, "y\n" + line, 3, "e", "f", 9), (2, line + "\n" + line, 4, "g", "h", 9), (None, None, 5, "i", "j", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _lost int, _kept string, keeper string, n_lines int")
    for hot in (1, 10_000):
        linededup.HOT_KEYS, old = hot, linededup.HOT_KEYS
        try:
            two = linededup.drop_lines(docs)
            assert two.columns == [*docs.columns, "n_dropped"]
            assert [tuple(r) for r in two.orderBy("_lost").collect()] == [(*r[:5], len((r[1] or "").split("\n")), 0) if r[1] else (None, "", 5, "i", "j", 1, 0) for r in rows]
            third = docs.unionByName(docs.where("doc_id = 2").withColumn("doc_id", F.lit(3).cast("long")).withColumn("_lost", F.lit(6)))
            got = {r["_lost"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.drop_lines(third).collect()}
            assert got == {1: (line + "\nx", 2, 0), 2: ("", 1, 1), 3: ("y", 2, 1), 4: ("", 2, 2), 5: ("", 1, 0), 6: (line + "\n" + line, 2, 0)}
        finally:
            linededup.HOT_KEYS = old


def test_line_dedup_is_linear_in_lines(spark):
    """Documents of very many lost lines; a square of them would take minutes."""
    def took(n):
        one = "\n".join(f"line number {i} of a long document" for i in range(n))
        docs = docs_of(spark, [(i, one) for i in range(3)])
        began = time.perf_counter()
        assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], len(r["text"])) for r in linededup.drop_lines(docs).collect()) == [(0, n, n, 0), (1, n, n, 0), (2, n, 0, len(one))]
        return time.perf_counter() - began

    took(1000)
    assert took(80_000) < 3 * took(20_000) + 20


# --- 5


def test_token_counts_are_brute_force(spark):
    scores = tokencount.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    byte = min(scores.values())

    def brute(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            options = [(best[k][0] + scores[word[k:i]], best[k][1] - 1) for k in range(i) if word[k:i] in scores]
            if word[i - 1] not in scores:
                n = len(word[i - 1].encode())
                options.append((best[i - 1][0] + n * byte, best[i - 1][1] - n))
            best.append(max(options))
        return -best[-1][1]

    rng = random.Random(13)
    rows = [(i, text(rng, 20)) for i in range(20)] + [(50, "x" * 100 + " \x07 日本語 the"), *ODD]
    got = tokencount.token_counts(docs_of(spark, rows), public_tokenizers.path("piece_bpe_32k.model")).collect()
    cache = {}
    total = lambda t: sum(cache.setdefault(w, brute(tokencount.MARK + w)) for w in (t or "").split())
    assert Counter((r["doc_id"], r["n_words"], r["n_tokens"]) for r in got) == Counter((i, len((t or "").split()), total(t)) for i, t in rows)


# --- 6


def test_neighbours(spark):
    rng = np.random.default_rng(15)
    x = rng.standard_normal((1500, 32)).astype(np.float32)
    x[200:500] = x[0]  # a common vector
    x[700:800] = x[100:200] + 0.05 * rng.standard_normal((100, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2050, [0.0] * 32), (2100, [float("nan")] * 32), (2150, [1.0]), (2200, [None] * 32), (3, x[3].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.expr("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    n = np.sqrt((x.astype(float) ** 2).sum(1))
    hit = 0
    assert set(got) == set(range(0, 1500, 50))
    for q, found in got.items():
        s = (x.astype(float) @ x[q].astype(float)) / (n * n[q])
        s[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(abs(s[f[1]] - f[2]) < 1e-9 for f in found)
        hit += len({f[1] for f in found} & set(best.tolist()))
    assert hit / (5 * len(got)) >= 0.9
    assert [f[1] for f in got[250]] == [0, 200, 201, 202, 203]
    old, ann.BATCH_BYTES, ann.BLOCK_BYTES = (ann.BATCH_BYTES, ann.BLOCK_BYTES), 2000, 1 << 18  # several batches and blocks give the same
    try:
        again = ann.nearest(df.select("vec_id", "embedding", F.lit(1).alias("v"), F.lit(2).alias("score")), F.expr("vec_id % 50 = 0")).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"]) for r in again} == {(q, *f[:2]) for q, found in got.items() for f in found}
    finally:
        ann.BATCH_BYTES, ann.BLOCK_BYTES = old
    huge = spark.createDataFrame([(None, [1.0, 2.0]), (0, [1e200, 0.0]), (1, [1e180, 1e180]), (2, [1e-200, 1e-201]), (3, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], round(r["score"], 9)) for r in ann.nearest(huge, F.expr("vec_id = 0"), k=2).orderBy("rank").collect()] == [(2, round(1 / 1.01**0.5, 9)), (1, round(0.5**0.5, 9))]
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert ann.nearest(few, F.expr("vec_id = 0")).count() == 2
    assert ann.nearest(few.limit(0), F.lit(True)).count() == 0


def test_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 1 << 16, (4000, 4), dtype=np.uint16)
    for r in (0, 5, 14, 23):
        index = ann.Index(code, r)
        for q in code[:5]:
            assert (index.within(q) == np.flatnonzero(ann.hamming(code, q) <= r)).all()


# --- 7


def test_fixity_locates_damage(spark):
    rng = random.Random(17)
    rows, at = [], {}
    for i in range(900):
        f = f"f{i % 3}"
        n = rng.randrange(200, 4000)
        rows.append((f, at.get(f, 0), n, hashlib.sha256(str(i).encode()).hexdigest()))
        at[f] = at.get(f, 0) + n
    damaged, lost, extra = rows[10], rows[500], ("f2", at["f2"], 5, "z")
    b = [r[:3] + ("bad",) if r is damaged else r for r in rows if r is not lost] + [extra]
    schema = "file string, offset long, length long, digest string"
    got = fixity.audit(spark.createDataFrame(rows, schema), spark.createDataFrame(b, schema), leaf_bytes=4096, fanout=4).collect()
    assert {(r["file"], r["offset"], r["status"]) for r in got} == {(*damaged[:2], "changed"), (*lost[:2], "missing"), (*extra[:2], "surplus")}
    none = spark.createDataFrame([], schema)
    assert fixity.audit(none, none).count() == 0
    assert fixity.audit(spark.createDataFrame(rows[:5], schema), none).count() == 5


def test_fixity_sees_through_moves(spark):
    """Lost, longer and added records move all after them; repeated names and places; clashing and null columns."""
    rng = random.Random(18)
    pages = [(i, f"http://x/{i % 50}", "body " * rng.randrange(1, 60)) for i in range(400)] + [(400, None, None), (401, "u", None)]
    lost, grown, added, swapped = {7, 200, 399}, {100, 250}, [(500, "new", "n"), (501, "new", "n")], {30}
    other = [(i, u, (h or "") + "!" * 500 if i in grown else "B" + (h or "")[1:] if i in swapped else h) for i, u, h in pages if i not in lost] + added
    schema = "page_id long, url string, html string, file string, length int, digest string, offset string, name string"
    table = lambda rows: spark.createDataFrame([(*r, "f", 1, None, "o", None) for r in rows], schema)
    index = lambda rows: fixity.warc_index(table(rows), F.floor(F.col("page_id") / 150), ["page_id"], fixity.warc_record(F.col("url"), F.col("html")), F.col("page_id"))
    got = fixity.audit(index(pages), index(other), leaf_bytes=1024, fanout=3).collect()
    want = {(i, "missing") for i in lost} | {(i, "changed") for i in grown | swapped} | {(i, "surplus") for i, *_ in added}
    assert Counter((int(r["name"]), r["status"]) for r in got) == Counter(want)
    at = {r["name"]: (r["offset"], r["length"]) for r in index(pages).collect()}
    assert all((r["offset"], r["length"]) == at[r["name"]] for r in got if r["status"] != "surplus")
    twice = [("f", 0, 5, "a", "n"), ("f", 5, 5, "a", "n"), ("f", 10, 5, "b", "n"), ("f", 10, 5, None, None)]
    copies = spark.createDataFrame(twice, "file string, offset long, length long, digest string, name string")
    assert fixity.audit(copies, copies).count() == 0
    assert [(r["status"], r["digest_a"]) for r in fixity.audit(copies, copies.where("offset <> 5")).collect()] == [("missing", "a")]


# --- 8


def brute_distance(item, t):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, p in enumerate(item, 1):
            new.append(min(row[i - 1] + (p != c), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_decontamination_is_brute_force(spark):
    rng = random.Random(19)
    items = [(k, text(rng, 6)) for k in range(6)] + [(7, None), (8, "  "), (9, "tiny")]
    rows = []
    for i in range(60):
        t = text(rng, 15)
        if i % 2:
            item = list(items[i % 6][1])
            for _ in range(rng.randrange(0, 9)):
                p = rng.randrange(len(item))
                item[p : p + 1] = rng.choice(([], ["x"], [item[p], "y"]))
            t += "\n" + "".join(item).upper() + "  " + text(rng, 5)
        rows.append((i, t))
    rows += ODD
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, t in rows:
        for k, item in items:
            if item and item.strip():
                item = decontaminate.normal(item)
                d = brute_distance(item, decontaminate.normal(t or "")[:2000])
                if d <= int(0.1 * len(item)):
                    want[i, k] = d
    assert got == want and len(want) > 10
    assert decontaminate.decontaminate(docs_of(spark, rows), spark.createDataFrame([], "item_id long, text string")).count() == len(rows)


# --- 9


def test_packing(spark):
    from tokenizers import Tokenizer

    rng = random.Random(21)
    rows = [(i, text(rng, rng.randrange(1, 400))) for i in range(150)] + ODD + [(950, "I'll \x1c don't <|endoftext|> naïve** İx Σ")]
    got = packing.pack(docs_of(spark, rows), TOKENIZER, size=512).toPandas()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((i, k, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes())) for k, a in enumerate(range(0, len(ids), 512)))
    assert Counter(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 512 and (s["offset"].to_numpy() == np.cumsum([0, *s["length"]])[:-1]).all()
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 512) + 1
    assert packing.pack(docs_of(spark, []), TOKENIZER).count() == 0


def test_short_documents_fill_sequences(spark):
    """No constraint but tokens costs a sequence, unless one is asked for."""
    none = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    for limit, want in ((None, 2), (1000, 6)):
        got = packing.pack(none, TOKENIZER, max_documents=limit).groupBy("sequence_id").agg(F.count("*").alias("n"), F.count_distinct("offset").alias("places")).collect()
        assert len(got) == want and all(r["n"] == r["places"] <= (limit or 4096) for r in got)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    rng = np.random.default_rng(2)
    n = rng.integers(1, 100, 300)
    where, offset = packing.fit_vectors(n, (256.0, 6.0, 20000.0), (1.0, 0.5, 0.5), rule)
    for b in np.unique(where):
        x = n[where == b]
        assert x.sum() <= 256 and len(x) <= 6 and (x.astype(float) ** 2).sum() <= 20000
        assert sorted(offset[where == b]) == sorted(np.cumsum([0, *x[np.argsort(offset[where == b])]])[:-1])


# --- 10


def test_resampling_keeps_the_target(spark):
    rng = random.Random(23)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        rows.append((i, text(rng, 80) if good else " ".join("*#&"[rng.randrange(3)] * 3 + rng.choice(WORDS) for _ in range(80))))
        if i % 2 == 0:
            labels.append((i, int(good)))
    rows += [(1000, ""), (1001, None)]
    df = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality.resample(docs_of(spark, rows), df, keep=0.7).collect()}
    assert len(kept) == round(0.7 * 402)
    assert sum(i % 4 != 0 for i in kept if i < 400) / len([i for i in kept if i < 400]) > 0.95
    assert quality.resample(docs_of(spark, []), df).count() == 0


def test_importance_weights_are_brute_force(spark):
    """Log weights against sums over plain counts, and the draw against all keys sorted."""
    rng = random.Random(29)
    rows = [(i, text(rng, rng.randrange(0, 60)) + "!?") for i in range(80)] + ODD + [(950, "x" * 200_000)]
    good = [0, 3, 7, 11, 50, 901]
    grams = quality.Grams()
    bags = [(i, Counter(grams.counts(t or "").tolist())) for i, t in rows]
    raw, target = Counter(), Counter()
    for i, b in bags:
        raw.update(b)
        if i in good:
            target.update(b)
    p = lambda c, k: log((c[k] + 1) / (c.total() + quality.BUCKETS))
    want = [(i, b.total(), round(sum(n * (p(target, k) - p(raw, k)) for k, n in b.items()), 5)) for i, b in bags]
    docs = docs_of(spark, rows)
    ratio = quality.models(docs, spark.createDataFrame([(i,) for i in good], "doc_id long"))
    got = quality.log_weights(docs, ratio).collect()
    assert Counter((r["doc_id"], r["n_grams"], round(r["log_weight"], 5)) for r in got) == Counter(want)
    labels = spark.createDataFrame([(i, 1) for i in good] + [(5, 0)], "doc_id long, quality int")
    drawn = quality.resample(docs, labels, keep=0.5, seed=3).collect()
    noise = {r["doc_id"]: r["g"] for r in docs.select("doc_id", quality.gumbel(F.col("doc_id"), 3).alias("g")).collect()}
    keys = sorted(((w + noise[i], i) for i, _, w in want), key=lambda x: (-x[0], x[1]))[: round(0.5 * len(rows))]
    assert Counter(r["doc_id"] for r in drawn) == Counter(i for _, i in keys)


def test_top_k_is_exact(spark):
    rng = random.Random(25)
    rows = [(i, float(rng.randrange(50))) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, key double")
    for k in (0, 1, 77, 499, 500, 600):
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        assert sorted((r["doc_id"], r["key"]) for r in quality.top_k(df, "key", "doc_id", k, ranges=8).collect()) == sorted(want)
