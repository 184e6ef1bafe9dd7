"""Vector best-fit packing of tokenised documents into sequences.

A document is its token ids and an end id; one longer than a sequence is cut into full pieces and a rest. A piece asks of
a sequence a vector: its tokens, one document, and its attention cost (tokens squared). A sequence has a capacity for
each. Pieces are placed by decreasing length, each into an open sequence that can take it under every constraint,
chosen by the smallest weighted norm of what remains, or by the largest weighted dot product of the piece with what
remains; if none can, a new one is opened.

Tokenising is per document. The pieces, a few numbers each, are dealt by a hash of their ids to groups of about
GROUP_TOKENS tokens, packed in a task each; as a group fills hundreds of sequences and has short pieces to
close gaps with, dealing costs less than a sequence a group. Then the sequences with room left, from all groups, are
opened and their pieces dealt and packed again, in ever fewer groups, so that little more than a few are left part-full.
No group depends on a source, a language or copies of a text.

Words are tokenised once per task and kept by a bounded dictionary. The tokenizer's normaliser and splitter never look
across ASCII white space, so a text's ids are its white-space-separated chunks' ids in a row (tested against the whole text).

Defined results: a null or empty text is the end id alone; repeated rows are packed each; an empty table gives no rows;
extra columns are ignored; a null doc_id is packed like any other.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, slices, texts

#: Tokens per packing group: over a thousand sequences of 4096.
GROUP_TOKENS = 6_000_000
KEPT = 600_000


class Words:
    """Token ids of texts, by way of their chunks between ASCII white space, each tokenised once.

    Most chunks are a word of Latin letters, with or without ASCII marks after it. The splitter makes one part of such a word and
    one of its marks, so these parts go straight to the tokenizer's model, in the byte alphabet that its splitter
    would give them; all other chunks go through the whole tokenizer.
    """

    PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    MARKS = b".,;:!?|*&%$#"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {b"": b""}
        # Printable bytes stand for themselves in the byte alphabet, the others for U+0100 and up, in order.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(x for x in range(0x100) if x not in shown)}

    def _part(self, part: bytes) -> bytes:
        if (found := self.parts.get(part)) is None:
            text = part.decode() if part.isascii() else part.decode().lower().encode().decode("latin-1").translate(self.alphabet)
            ids = [t.id for t in self.model.tokenize(text)]
            found = self.parts[part] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _learn(self, chunks: set[bytes]) -> None:
        odd = []
        for c in chunks:
            word = c.rstrip(self.MARKS)
            if self.PLAIN.fullmatch(word):
                self.known[c] = self._part(word.lower()) + self._part(c[len(word) :])
            else:
                odd.append(c)
        for at in range(0, len(odd), 10_000):
            part = odd[at : at + 10_000]
            for c, x in zip(part, self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in part], add_special_tokens=False), strict=True):
                self.known[c] = np.array(x.ids, "<u4").tobytes()

    def ids(self, rows: list[bytes]) -> list[np.ndarray]:
        chunks = [x.split() for x in rows]
        fresh = set().union(*chunks).difference(self.known)
        if len(self.known) + len(fresh) > KEPT:
            self.known, self.parts = {}, {b"": b""}
            fresh = set().union(*chunks)
        self._learn(fresh)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, row)), "<u4") for row in chunks]


_SHARED: dict[str, Words] = {}


def shared_words(path: str) -> Words:
    """One dictionary for all tasks that a Python worker runs."""
    if path not in _SHARED:
        _SHARED.clear()
        _SHARED[path] = Words(path)
    return _SHARED[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), and no_row, which tells repeated rows apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = shared_words(tokenizer)
        for ids, rows in slices(batches, 64):
            out = []
            for doc_id, tokens in zip(ids, words.ids(rows), strict=True):
                tokens = np.append(tokens, np.array([end], "<u4"))
                for k, at in enumerate(range(0, len(tokens), size)):
                    part = tokens[at : at + size]
                    out.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int32() if k == 1 else pa.int64()) for k in range(5)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fit_vectors(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """The bin and the place of each piece. capacity and weights: tokens, documents, attention cost."""
    cap, w = np.array(capacity, float), np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    room = np.empty((len(lengths), 3))
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins, live = 0, np.zeros(0, np.int64)  # live: bins that can still take something
    least = lengths.min() if len(lengths) else 0
    for i in order:
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        best = -1
        if len(live):
            left = room[live] - need
            ok = (left >= 0).all(1)
            if ok.any():
                share = left / cap
                value = (w * share * share).sum(1) if rule == "norm" else -(w * (need / cap) * (room[live] / cap)).sum(1)
                best = int(np.argmin(np.where(ok, value, np.inf)))
        if best < 0:
            room[bins] = cap
            live = np.append(live, bins)
            best, bins = len(live) - 1, bins + 1
        b = live[best]
        where[i], offset[i] = b, capacity[0] - room[b, 0]
        room[b] -= need
        if room[b, 0] < least or room[b, 1] < 1 or room[b, 2] < float(least) ** 2:
            live = np.delete(live, best)
    return where, offset


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 4096,
    end: int = 1,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.5, 0.5),
    rule: str = "norm",
    rounds: int = 3,
) -> DataFrame:
    """pieces() with sequence_id and offset. By default a sequence takes as many documents as tokens, and the attention cost of one full piece, so that neither costs a sequence; residuals of tokens, documents
    and attention cost weigh 1, 0.5 and 0.5."""
    capacity = (float(size), float(max_documents or size), float(max_attention or size * size))
    if max_attention and max_attention < size * size:
        raise ValueError("a full piece must fit an empty sequence")
    todo = checkpointed(pieces(docs, tokenizer, size, end).withColumn("seed", F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, seed long, sequence_id long, offset long, used long"

    def of(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "seed"], ascending=[False, True], kind="stable").reset_index(drop=True)
        where, offset = fit_vectors(frame["length"].to_numpy(), capacity, weights, rule)
        used = np.bincount(where, frame["length"])[where].astype(np.int64)
        return frame.drop(columns=["_group"]).assign(sequence_id=(int(key[0]) << 32) + where, offset=offset, used=used)

    done = []
    for k in range(rounds):
        total = todo.agg(F.sum("length")).first()[0] or 0
        groups = max(1, -(-total // GROUP_TOKENS))
        placed = todo.withColumn("_group", F.pmod(F.xxhash64("seed", F.lit(k)), F.lit(groups)) + F.lit(k << 28))
        last = k == rounds - 1 or groups == 1
        packed = placed.repartition(max(1, groups), "_group").groupBy("_group").applyInPandas(of, schema)
        packed = checkpointed(packed)
        if last:
            done.append(packed)
            break
        done.append(packed.where(F.col("used") == size))
        todo = packed.where(F.col("used") < size).select(todo.columns)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
