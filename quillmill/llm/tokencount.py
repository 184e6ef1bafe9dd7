"""Token counts under a unigram model, by dynamic programming shared along a trie.

A pre-token (a word with the word-begin mark before it) is segmented into pieces of a public vocabulary so that the sum of the
pieces' log probabilities is largest; between equal sums, into fewer pieces. The best sum for a prefix does not depend on what
follows, so distinct pre-tokens go into a trie, the forward score is computed once for each of its nodes, that is once for each shared
prefix, and a word's end holds its token count. Only then are a document's words looked up and summed.

The file gives pieces in order of rank; a piece of rank r has probability in proportion to 1 / (r + 3) (Zipf's law). A
character that no piece holds is as many byte pieces as UTF-8 needs, each as likely as the last rank.

The trie is a task's, bounded by MAX_NODES and begun anew beyond it; words of any frequency are looked up where their text is, so nothing is shuffled.

Defined results: null, empty and blank texts have no words and no tokens; repeated rows give a row each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, texts

MARK = "▁"
MAX_NODES = 1_500_000
#: Longer words are not kept in the trie; they are computed alone, in memory that follows their length.
LONG = 64


def piece_scores(model_path: str) -> dict[str, float]:
    """Log probability by piece, byte and control pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    norm = math.log(sum(1 / (r + 3) for r in range(len(plain))))
    return {model.id_to_piece(i): -math.log(r + 3) - norm for r, i in enumerate(plain)}


class Trie:
    def __init__(self, scores: dict[str, float]) -> None:
        self.scores, self.widest, self.byte = scores, max(map(len, scores), default=1), min(scores.values(), default=-1.0)
        self.clear()

    def clear(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.best, self.tokens, self.ends = [0.0], [0], {}

    def step(self, word: str, i: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """The forward score and token count of word[:i], from those of its prefixes."""
        c = word[i - 1]
        top, n = -math.inf, 0
        if c not in self.scores:
            width = len(c.encode("utf-8", "surrogatepass"))
            top, n = best[i - 1] + width * self.byte, tokens[i - 1] + width
        get = self.scores.get
        for k in range(max(0, i - self.widest), i):
            s = get(word[k:i])
            if s is not None and (s + best[k] > top or s + best[k] == top and tokens[k] + 1 < n):
                top, n = s + best[k], tokens[k] + 1
        return top, n

    def count(self, word: str) -> int:
        """Tokens of one pre-token; its path in the trie is made where it is new."""
        if (known := self.ends.get(word)) is not None:
            return known
        node, best, tokens = 0, [0.0], [0]
        for i, c in enumerate(word, 1):
            child = self.next[node].get(c) if node >= 0 else None
            if child is None:
                top, n = self.step(word, i, best, tokens)
                if len(word) <= LONG:
                    child = self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.best.append(top)
                    self.tokens.append(n)
            else:
                top, n = self.best[child], self.tokens[child]
            node = -1 if child is None else child
            best.append(top)
            tokens.append(n)
        if len(word) <= LONG:
            self.ends[word] = tokens[-1]
        return tokens[-1]


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_words long, n_tokens long), a row for each row of docs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(piece_scores(model_path))
        for ids, rows in slices(batches):
            words = [[MARK + w for w in x.decode("utf-8", "replace").split()] for x in rows]
            if len(trie.next) > MAX_NODES:
                trie.clear()
            counts = {w: trie.count(w) for w in sorted({w for row in words for w in row}.difference(trie.ends))}
            ends = trie.ends
            totals = [sum(ends[w] if w in ends else counts[w] for w in row) for row in words]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(list(map(len, words)), pa.int64()), pa.array(totals, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return texts(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
