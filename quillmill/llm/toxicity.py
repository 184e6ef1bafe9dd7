"""Toxicity by a support vector machine on a gapped subsequence string kernel, with Nystroem landmarks.

The unit is a sentence, as a row of letters: ASCII case is folded, marks and digits are left out, white space is one edge letter. So
an insult with a letter put in or changed ("idxiot"), cut by marks or blanks ("i.d.i.o.t", "id iot", "i d i o t") or of several
words lies in one row with its neighbours. The kernel compares windows of a sentence: the inner product of the subsequences of
ORDER letters that begin at one of STARTS letters in a row and span at most SPAN letters, each worth DECAY to the power of the letters it skips.

Training is on the sentences of labelled documents. A sentence inherits its document's label, which says only that some
sentence of a toxic document insults; so the examples are taken from the sentences of toxic documents where a run of
one of LENGTHS letters stands that tells toxic documents from clean ones (telling_runs). Windows of clean documents'
sentences are the negatives: a bounded sample of them at first, then the largest values that a first machine gives to clean
sentences. A squared-hinge machine is fitted on the Nystroem map of LANDMARKS windows. As the kernel's features can be
written out, the machine folds into one table of weights by subsequence, so every window of every sentence of a whole text is valued exactly.

A document's evidence is the largest values of its two worst sentences and, against it, how long its text is, as a long one holds any
run of letters sooner by chance. A logistic curve fitted on the training documents turns these into a score. Labels are taken from at most max_toxic and max_clean labelled documents, chosen by the hash of their
id; examples from these are bounded by max_windows; everything else covers all rows.

Defined results: null and empty texts, and those without letters, get the score of a text without any sentence; with no labelled toxic document
at all every score is zero; labels that are null are not used; of rows repeated under one labelled id the text that is least in order is learnt from;
repeated rows give a row each; a null doc_id is scored like any other; extra columns are ignored; a text beyond PART bytes is taken in parts cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, by_hash, checkpointed, slices, texts

ORDER, SPAN, DECAY = 4, 7, 0.7
#: Starts of a window: it takes the subsequences that begin at one of so many letters in a row.
STARTS = 6
WINDOW = STARTS + SPAN - 1
LANDMARKS = 512
#: Letters are 1 to 26, those of ACCENTED 27 to 30 and 32 to 43, any other 44, an edge of words 31; 0 stands between sentences.
EDGE, OTHER, CODES = 31, 44, 48
# Frequent letters beyond ASCII, each with a code of its own, capitals with them.
ACCENTED = "äöüßéèêçàñáíóúôî"
#: Letters of runs that may tell toxic documents from clean ones: where short ones stand in clean words as well, a longer one may not.
LENGTHS = (5, 7, 9, 11)
RUN = LENGTHS[0]
SIDE = 3
#: Bounds of a sentence's decision value as evidence.
LOWEST, HIGHEST = -2.0, 4.0
PART = 1 << 22
#: Letters whose windows are valued at once: so many that the arrays stay in a processor's cache.
CHUNK = 1 << 14
COMBOS = [(c, DECAY ** (c[-1] + 1 - ORDER)) for c in combinations(range(1, SPAN), ORDER - 1)]
_STOP, _ROW, _NONE = 60, 61, 255
_LETTER = np.full(256, _NONE, np.uint8)
_LETTER[65:91] = _LETTER[97:123] = np.arange(1, 27)
_LETTER[0x80:0xC0] = OTHER
for _i, _c in enumerate(ACCENTED):  # of two bytes, the last tells the letter; a capital's is lower by 32
    for _b in {_c.encode()[1], _c.upper().encode()[1] if _c != "ß" else _c.encode()[1]}:
        _LETTER[_b] = 27 + _i + (_i > 3)
_LETTER[list(ASCII_SPACE.encode())] = EDGE
_LETTER[10] = 0
_LETTER[list(b".!?")] = _STOP


def parts_of(rows: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The rows, very long ones in parts, and the number of each part's row."""
    parts, owner = [], []
    for i, x in enumerate(rows):
        at = 0
        while len(x) - at > PART:
            cut = max(x.rfind(c, at, at + PART) for c in (b"\n", b" ", b"\t")) + 1
            cut = cut if cut > at else at + PART
            parts.append(x[at:cut])
            owner.append(i)
            at = cut
        parts.append(x[at:] if at else x)
        owner.append(i)
    return parts, np.array(owner, np.int64)


def _is_letter(c: np.ndarray) -> np.ndarray:
    return (c > 0) & (c < CODES) & (c != EDGE)


def sentences(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all rows' sentences, each between two edges and with zeros after it; where each sentence begins; and its row.

    A sentence ends at a newline, and at a full stop, exclamation or question mark before white space, unless a word of one letter stands before the mark.
    """
    raw = np.frombuffer(b"\n".join(rows) + b"\n\0\0\0", np.uint8)
    c = _LETTER[raw]
    c[np.cumsum([len(x) + 1 for x in rows]) - 1] = _ROW
    c = c[:-3]
    for lead, n in ((0xC2, 1), (0xE2, 2), (0xF0, 3)):  # signs beyond ASCII, not letters
        at = np.flatnonzero(raw[:-3] == lead)
        for k in range(1, n + 1):
            c[at[_is_letter(c[at + k - (at + k >= len(c))])] + k] = _NONE
    stop = np.flatnonzero(c == _STOP)
    over = lambda x: (x == EDGE) | (x == 0) | (x == _ROW)
    one = (stop < 2) | over(c[np.maximum(stop - 2, 0)])
    one &= (stop > 0) & _is_letter(c[np.maximum(stop - 1, 0)])
    c[stop] = np.where(over(c[stop + 1]) & ~one, 0, _NONE)
    c = c[c != _NONE]
    before = np.concatenate([[_ROW], c[:-1]])
    c = c[(c != EDGE) | ~over(before)]
    before, after = np.concatenate([[_ROW], c[:-1]]), np.concatenate([c[1:], [_ROW]])
    ends = lambda x: (x == 0) | (x == _ROW)
    c = c[~((c == 0) & ends(before)) & ~((c == EDGE) & ends(after))]
    end = ends(c)
    width = np.where(end, SPAN + 1, 1)
    last = np.cumsum(width)[end]  # in out, the last cell that an end is widened to
    out = np.concatenate([[np.uint8(EDGE)], np.repeat(np.where(end, np.uint8(0), c), width)])
    out[last] = out[last - SPAN] = EDGE
    begins = np.concatenate([[0], last])[:-1]
    row = np.concatenate([[0], np.cumsum(c[end] == _ROW)])[:-1]
    full = np.diff(np.concatenate([begins, [len(out) - 1]])) > SPAN + 1
    return out[:-1], begins[full], row[full]


def window_values(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The machine's value of the window that begins at each letter, without the bias."""
    out = np.empty(len(codes), np.float32)
    index, value = np.empty((ORDER, CHUNK + STARTS), np.intp), np.empty(CHUNK + STARTS, np.float32)
    by_span = np.empty((SPAN, CHUNK + STARTS), np.float32)

    def walk(padded: np.ndarray, last: int, left: int, n: int) -> None:
        """All subsequences that go on from the one whose number is in index[left], which ends so many letters after the start."""
        index[left, :n] *= CODES
        for o in range(last + 1, SPAN - left + 1):
            np.add(index[left, :n], padded[o : o + n], out=index[left - 1, :n])
            if left > 1:
                walk(padded, o, left - 1, n)
            else:
                weights.take(index[0, :n], out=value[:n], mode="clip")
                by_span[o, :n] += value[:n]

    for at in range(0, len(codes), CHUNK):
        m = min(CHUNK, len(codes) - at)
        n = m + STARTS
        padded = np.zeros(n + SPAN, np.intp)
        part = codes[at : at + n + SPAN]
        padded[: len(part)] = part
        by_span[:] = 0
        index[ORDER - 1, :n] = padded[:n]
        walk(padded, 0, ORDER - 1, n)
        total = np.float32([DECAY ** (o + 1 - ORDER) for o in range(SPAN)]) @ by_span[:, :n]
        out[at : at + m] = sum(total[s : s + m] for s in range(STARTS))
    out[codes == 0] = -np.inf
    return out


def worst(rows: list[bytes], weights: np.ndarray, windows: bool = False) -> tuple[np.ndarray, list[list[bytes]]]:
    """The two largest values of each row's sentences, nan where there is none; and these windows' letters, if asked for."""
    parts, owner = parts_of(rows)
    codes, begins, row = sentences(parts)
    tops, found = np.full((len(rows), 2), np.nan), [[] for _ in rows]
    if not len(begins):
        return tops, found
    value = window_values(codes, weights)
    best, row = np.maximum.reduceat(value, begins), owner[row]
    order = np.lexsort((begins, -best, row))
    first = np.flatnonzero(np.concatenate([[True], row[order][1:] != row[order][:-1]]))
    for k in range(2):
        at = first + k
        at = at[at < np.append(first[1:], len(order))]
        at = order[at]
        tops[row[at], k] = best[at]
        if windows:
            padded = np.concatenate([codes, np.zeros(WINDOW, np.uint8)])
            for i, a, b in zip(row[at], begins[at], np.append(begins, len(codes))[at + 1], strict=True):
                p = a + int(np.argmax(value[a:b]))
                found[i].append(padded[p : p + WINDOW].tobytes())
    return tops, found


def packed(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subsequence numbers that have a weight, and the weights: as these stand in landmarks, some 0.5 MB travel where the table has 21."""
    at = np.flatnonzero(weights).astype(np.int32)
    return at, weights[at]


def unpacked(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    weights = np.zeros(CODES**ORDER, np.float32)
    weights[at] = values
    return weights


def packed_model(model: tuple[np.ndarray, np.ndarray] | None) -> tuple | None:
    return model and (packed(model[0]), model[1])


def unpacked_model(model: tuple | None) -> tuple[np.ndarray, np.ndarray] | None:
    return model and (unpacked(*model[0]), model[1])


def top_sentences(docs: DataFrame, weights: np.ndarray, windows: bool = False) -> DataFrame:
    """(doc_id, s1, s2, size, windows): values of each row's two worst sentences, null where there is none, the bytes of its text, and these sentences' worst windows, if asked for."""
    held = docs.sparkSession.sparkContext.broadcast(packed(weights))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unpacked(*held.value)
        for ids, rows in slices(batches):
            tops, found = worst(rows, table, windows)
            columns = [pa.array(tops[:, k], pa.float64(), from_pandas=True) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns, pa.array(map(len, rows), pa.int64()), pa.array(found, pa.list_(pa.binary()))], names=["doc_id", "s1", "s2", "size", "windows"])

    return docs.mapInArrow(run, "doc_id long, s1 double, s2 double, size long, windows array<binary>")


# --- training


def runs(codes: np.ndarray, length: int) -> np.ndarray:
    """The number of the run that begins at each letter; -1 where a sentence ends within it. As no code in a run is zero, runs of unlike lengths have unlike numbers."""
    n = max(0, len(codes) - length + 1)
    number, whole = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(length):
        part = codes[k : k + n]
        number = number * CODES + part
        whole &= part > 0
    return np.where(whole, number, -1)


def found_in(number: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where number has one of wanted, which are in order, and the place of each there."""
    if not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(wanted, number)
    at[at == len(wanted)] = 0
    hit = np.flatnonzero(wanted[at] == number)
    return hit, at[hit]


def counted_runs(docs: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """(run long, n long): in how many rows of docs each run stands; of those among so many, if given."""
    held = docs.sparkSession.sparkContext.broadcast(among)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held.value
        for _, rows in slices(batches, 2048):
            seen = []
            for x in rows:
                codes = sentences([x])[0]
                found = np.unique(np.concatenate([runs(codes, n) for n in LENGTHS]))
                seen.append(found if wanted is None else found[found_in(found, wanted)[0]])
            number, n = np.unique(np.concatenate(seen), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(n.astype(np.int64))], names=["run", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "run long, n long").where("run >= 0").groupBy("run").agg(F.sum("n").alias("n"))


def run_hits(docs: DataFrame, among: np.ndarray) -> DataFrame:
    """(run array<int>, around array<long>): for each row of docs the places in among of the runs it holds, each with a hash of itself and SIDE letters on both sides."""
    held = docs.sparkSession.sparkContext.broadcast(among)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held.value
        for _, rows in slices(batches):
            places, around = [], []
            for x in rows:
                codes, place, seen = sentences([x])[0], [], []
                padded = np.concatenate([np.zeros(SIDE, np.uint8), codes, np.zeros(LENGTHS[-1] + SIDE, np.uint8)])
                for n in LENGTHS:
                    at, of = found_in(runs(codes, n), wanted)
                    place += of.tolist()
                    seen += [xxhash.xxh64_intdigest(padded[p : p + n + 2 * SIDE].tobytes()) - (1 << 63) for p in at.tolist()]
                places.append(place)
                around.append(seen)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.list_(pa.int32())), pa.array(around, pa.list_(pa.int64()))], names=["run", "around"])

    return docs.select("doc_id", "text").mapInArrow(run, "run array<int>, around array<long>")


def telling_runs(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int, ratio: float = 20, times: int = 10) -> np.ndarray:
    """Runs that tell toxic documents, in order of their number.

    A run comes into question if its share of toxic documents is over ratio times its share of clean ones, and a log-likelihood ratio calls it no
    chance (over 14: less than one in a million runs). At best, where no clean document has it, that is t * log(all / toxic), so few runs are counted in
    clean documents at all; there are at most CODES ** RUN, whatever the sample. In copies of one text every run does so; hence only four times as many documents count as
    there are surroundings of SIDE letters in which the run stands. Of these runs the one that tells most is chosen again and again, and a
    document that holds so many chosen ones counts no more, so that words which merely stand beside insults have nothing left to tell.
    """
    every = n_toxic + n_clean
    least = max(3, int(np.ceil(14 / np.log(every / n_toxic))))

    def gains(t: np.ndarray, c: np.ndarray) -> np.ndarray:
        t, rate = np.maximum(t, 1), (t + c) / every
        gain = t * np.log(t / (n_toxic * np.maximum(rate, 1 / every))) + c * np.log(np.maximum(c, 1) / (n_clean * np.maximum(rate, 1 / every)))
        return np.where((t >= 3) & (t / n_toxic > ratio * c / n_clean) & (gain > 14), gain, 0)

    def told(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Runs in order and their counts, 16 bytes for each."""
        found = counts.toArrow()
        run, n = (found.column(k).to_numpy() for k in (0, 1))
        order = np.argsort(run)
        return run[order], n[order].astype(float)

    among, t = told(counted_runs(toxic).where(F.col("n") >= least))
    there, n = told(counted_runs(clean, among))
    c = np.zeros(len(among))
    c[np.searchsorted(among, there)] = n
    some = gains(t, c) > 0
    among, t, c = among[some], t[some], c[some]
    if not len(among):
        return among
    hits = run_hits(toxic, among).toArrow()
    run, around = (hits.column(c).combine_chunks() for c in ("run", "around"))
    row = np.repeat(np.arange(len(hits)), pc.list_value_length(run).to_numpy())
    run, around, n_rows = run.flatten().to_numpy(), around.flatten().to_numpy(), len(hits)
    del hits
    order = np.lexsort((around, run))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(run[order]) != 0) | (around[order][1:] != around[order][:-1])
    unlike = np.bincount(run[order[first]], minlength=len(among))
    del order, first, around
    live = gains(np.minimum(t, 4 * unlike), c) > 0
    # Which row holds which run, as the pairs alone: by row, and the rows by run.
    row, run = np.divmod(np.unique(row * len(among) + run), len(among))
    row_ends, run_ends = (np.cumsum(np.bincount(x, minlength=n)) for x, n in ((row, n_rows), (run, len(among))))
    rows_by_run = row[np.argsort(run, kind="stable")]
    within = lambda x, ends, k: x[ends[k - 1] if k else 0 : ends[k]]
    left, chosen, held = np.full(n_rows, times), [], np.bincount(run, minlength=len(among))
    while True:
        gain = np.where(live, gains(held.astype(float), c), 0)
        k = int(np.argmax(gain))
        if not gain[k]:
            return among[sorted(chosen)]
        chosen.append(k)
        live[k] = False
        members = within(rows_by_run, run_ends, k)
        left[members] -= 1
        for r in members[left[members] == 0].tolist():
            held[within(run, row_ends, r)] -= 1


def features(windows: list[bytes]) -> np.ndarray:
    """Subsequence numbers of each window, -1 where there is none; in the order of window_weights()."""
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW).astype(np.int64)
    out = np.empty((len(x), STARTS * len(COMBOS)), np.int32)
    for s in range(STARTS):
        for k, (offsets, _) in enumerate(COMBOS):
            index, ok = x[:, s], x[:, s] > 0
            for o in offsets:
                ok = ok & (x[:, s + o] > 0)
                index = index * CODES + x[:, s + o]
            out[:, s * len(COMBOS) + k] = np.where(ok, index, -1)
    return out


def window_weights() -> np.ndarray:
    return np.tile(np.array([w for _, w in COMBOS]), STARTS)


def kernel(x: np.ndarray, vocabulary: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Inner products of windows (feature numbers) with landmarks (rows of weights by place in the vocabulary)."""
    at = np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)
    w = np.where(vocabulary[at] == x, window_weights(), 0).astype(np.float32)
    return np.concatenate([np.einsum("ij,ijk->ik", w[i : i + 128], landmarks[at[i : i + 128]]) for i in range(0, len(x), 128)]) if len(x) else np.zeros((0, landmarks.shape[1]))


def svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps; the last column of z is all ones, and its coefficient the bias."""
    w = np.zeros(z.shape[1])

    def curvature(act: np.ndarray) -> np.ndarray:
        """Of the rows at act, a few of them at a time."""
        out = ridge * np.eye(len(w))
        for at in range(0, len(act), 2048):
            part = z[act[at : at + 2048]].astype(float)
            out += (part * weight[act[at : at + 2048], None]).T @ part
        return out

    # Products go by a few rows at a time too: z is of 32 bits, and whole it would be copied to 64 for each.
    parts = range(0, len(z), 2048)
    times = lambda w: np.concatenate([z[at : at + 2048] @ w for at in parts])
    turned = lambda v: sum((v[at : at + 2048] @ z[at : at + 2048] for at in parts), np.zeros(len(w)))
    loss = lambda w: ridge / 2 * w @ w + weight @ np.maximum(0, 1 - y * times(w)) ** 2 / 2
    for _ in range(30):
        miss = np.maximum(0, 1 - y * times(w))
        act = np.flatnonzero(miss > 0)
        grad = ridge * w - turned(weight * y * miss)
        step = np.linalg.solve(curvature(act), grad)
        size, now = 1.0, loss(w)
        while size > 1e-3 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-6:
            break
    return w


def machine(positive: list[bytes], negative: list[bytes]) -> tuple[np.ndarray, float]:
    """Weights by subsequence number, and the bias."""
    x = features(positive + negative)
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    some = lambda rows, n: rows[np.unique(np.linspace(0, len(rows) - 1, n).astype(int))]
    marks = np.concatenate([some(x[y > 0], LANDMARKS * 3 // 4), some(x[y < 0], LANDMARKS // 4)])
    vocabulary = np.unique(marks[marks >= 0])
    phi = np.zeros((len(vocabulary), len(marks)), np.float32)
    for k, row in enumerate(marks):
        ok = row >= 0
        np.add.at(phi[:, k], np.searchsorted(vocabulary, row[ok]), window_weights()[ok])
    phi /= np.sqrt((phi**2).sum(0)).mean()
    s, u = np.linalg.eigh((phi.T @ phi).astype(float))
    keep = s > s.max() * 1e-4
    root = u[:, keep] / np.sqrt(s[keep])
    z = np.ones((len(x), root.shape[1] + 1), np.float32)
    for at in range(0, len(x), 2048):
        z[at : at + 2048, :-1] = kernel(x[at : at + 2048], vocabulary, phi) @ root
    w = svm(z, y, np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * 1000)
    weights = np.zeros(CODES**ORDER, np.float32)
    weights[vocabulary] = phi @ (root @ w[:-1])
    return weights, float(w[-1])


def machine_by_task(spark: SparkSession, positive: list[bytes], negative: list[bytes]) -> tuple[np.ndarray, float]:
    """machine() in a task of its own: of its matrices, which the sample bounds, the driver holds none and gets 8 bytes for each subsequence that has a weight."""
    both, n = b"".join(positive + negative), len(positive)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            windows = [both[at : at + WINDOW] for at in range(0, len(both), WINDOW)]
            weights, bias = machine(windows[:n], windows[n:])
            at, values = packed(weights)
            yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["at", "values", "bias"])

    row = spark.range(1, numPartitions=1).mapInArrow(run, "at binary, values binary, bias double").first()
    return unpacked(np.frombuffer(row["at"], np.int32), np.frombuffer(row["values"], np.float32)), row["bias"]


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a little ridge, by Newton steps; bias last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (weight * (p - y)) + 1e-2 * w)
        w -= np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 3000, max_clean: int = 6000, max_windows: int = 20_000) -> tuple[np.ndarray, np.ndarray] | None:
    """The weights by subsequence and the curve's coefficients; None if no labelled document is toxic. labels: (doc_id, toxic), already without held-out rows."""
    labels = checkpointed(labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = by_hash(labels.where("toxic = 1"), max_toxic, "doc_id").unionByName(by_hash(labels.where("toxic = 0"), max_clean, "doc_id"))
    # At most max_toxic + max_clean ids of 16 bytes are broadcast, whatever the input.
    sample = checkpointed(texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"))
    n = dict(sample.groupBy("toxic").count().collect())
    if not n.get(1):
        return None
    toxic, clean = sample.where("toxic = 1"), sample.where("toxic = 0")
    telling = telling_runs(toxic, clean, n[1], n.get(0, 0) + 1)
    if not len(telling):
        return None

    def insults(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows around what telling runs cover together: one that begins a letter before it, and one that ends a letter after."""
        for _, rows in slices(batches):
            found = set()
            for x in rows:
                codes = sentences([x])[0]
                inside = np.zeros(len(codes) + 2, np.int64)
                for n in LENGTHS:
                    at, _ = found_in(runs(codes, n), telling)
                    np.add.at(inside, at + 1, 1)
                    np.add.at(inside, at + 1 + n, -1)
                change = np.flatnonzero(np.diff((np.cumsum(inside) > 0).astype(np.int8), prepend=0))  # in pairs: where a stretch begins and ends, a letter late
                padded = np.concatenate([codes, np.zeros(WINDOW, np.uint8)])
                for a, e in zip((change[::2] - 1).tolist(), (change[1::2] - 1).tolist(), strict=True):
                    found |= {padded[p : p + WINDOW].tobytes() for p in (max(0, a - 1), max(0, e + 1 - WINDOW))}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(w for w in found if w[0]), pa.binary())], names=["window"])

    each = -(-max_windows // max(1, n.get(0, 0)))

    def ordinary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of clean sentences, as many of each document, at places that its id draws."""
        for ids, rows in slices(batches):
            found = []
            for i, x in zip(ids, rows, strict=True):
                codes = sentences([x])[0]
                at = np.flatnonzero(codes)
                at = np.random.default_rng(i & 0x7FFFFFFF).choice(at, min(each, len(at)), replace=False) if len(at) else at
                padded = np.concatenate([codes, np.zeros(WINDOW, np.uint8)])
                found += [padded[p : p + WINDOW].tobytes() for p in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["window"])

    windows = lambda df, f: df.select("doc_id", "text").mapInArrow(f, "window binary").groupBy("window").agg(F.count("*").alias("n"))
    positive = [bytes(r["window"]) for r in windows(toxic, insults).orderBy(F.desc("n"), "window").limit(max_windows // 4).collect()]
    negative = [bytes(r["window"]) for r in by_hash(windows(clean, ordinary), max_windows, "window").select("window").collect()]
    for _ in range(2):
        weights, _ = machine_by_task(docs.sparkSession, positive, negative)
        tops = top_sentences(clean.select("doc_id", "text"), weights, windows=True)
        hard = tops.select(F.explode(F.arrays_zip(F.array("s1", "s2").alias("s"), "windows")).alias("x")).where("x.windows is not null").groupBy("x.windows").agg(F.max("x.s").alias("s")).orderBy(F.desc("s"), "windows").limit(max_windows // 4)
        negative += [bytes(r["windows"]) for r in hard.collect()]
    weights, bias = machine_by_task(docs.sparkSession, positive, negative)
    seen = top_sentences(sample.select("doc_id", "text"), weights).join(F.broadcast(chosen), "doc_id").select("s1", "s2", "size", "toxic").collect()
    x = np.hstack([evidence(np.array([[r["s1"], r["s2"]] for r in seen], float), bias), -np.log1p([[r["size"]] for r in seen])])
    y = np.array([r["toxic"] for r in seen], float)
    there = dict(labels.groupBy("toxic").count().collect())
    share = there[1] / sum(there.values())
    weight = np.where(y > 0, share / y.mean(), (1 - share) / max(1e-9, 1 - y.mean()))
    # More evidence never lowers a score, more text never raises it: what misleads is left out.
    use = [0, 1, 2]
    while (w := curve(x[:, use], y, weight))[:-1].min(initial=0) < 0:
        use.pop(int(np.argmin(w[:-1])))
    full = np.zeros(4)
    full[[*use, 3]] = w
    return weights, np.append(full, bias)


def evidence(tops: np.ndarray, bias: float) -> np.ndarray:
    """Decision values between LOWEST and HIGHEST; a missing sentence counts as LOWEST."""
    return np.clip(np.nan_to_num(tops + bias, nan=LOWEST, posinf=HIGHEST, neginf=LOWEST), LOWEST, HIGHEST)


def scores(rows: list[bytes], model: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(rows))
    weights, (a, b, g, c, bias) = model
    held = evidence(worst(rows, weights)[0], bias)
    return 1 / (1 + np.exp(-(held @ [a, b] - g * np.log1p([len(x) for x in rows]) + c)))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """(doc_id, score double): a row for each row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(packed_model(model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked_model(held.value)
        for ids, rows in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scores(rows, known))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of held-out documents are never read."""
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns, which are filtered where they are scored. A row with a null doc_id is scored with the rest; repeated rows stay or go together."""
    held = docs.sparkSession.sparkContext.broadcast(packed_model(fit(docs, labels.where(~held_out()))))
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked_model(held.value)
        for batch in batches:
            text = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), pc.fill_null(batch.column(at).cast(pa.large_string()), "")], names=["none", "text"])
            clean = [x < 0.5 for _, rows in slices([text]) for x in scores(rows, known)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
