"""Greedy word-piece token counts with a linear longest-match automaton (operator 1).

The vocabulary is a trie with two roots: pieces that begin a word, and pieces that continue one. Each node carries a
failure link and the number of pieces that are finished when the link is taken, so one pass over a word's characters
gives the number of its greedy longest-match pieces without building any. A word that can't be covered counts as one
unknown token, as in word-piece models.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.llm.common import in_arrow

WORD_MARK = "▁"
CACHE = 300_000


class LongestMatch:
    """Counts pieces of a word; ``start`` and ``inner`` are the pieces that begin and continue a word."""

    def __init__(self, start: Iterable[str], inner: Iterable[str]) -> None:
        self.child: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, start), (1, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.child[node].get(c)
                    if nxt is None:
                        nxt = self.child[node][c] = len(self.child)
                        self.child.append({})
                        ends.append(False)
                    node = nxt
                if piece:
                    ends[node] = True
        self.fail = [-1] * len(self.child)
        self.popped = [0] * len(self.child)
        queue = deque((0, 1))
        while queue:
            node = queue.popleft()
            for c, nxt in self.child[node].items():
                queue.append(nxt)
                if ends[nxt]:
                    self.fail[nxt], self.popped[nxt] = 1, 1
                    continue
                z, n = self.fail[node], self.popped[node]
                while z >= 0 and c not in self.child[z]:
                    n += self.popped[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[nxt], self.popped[nxt] = self.child[z][c], n

    def count(self, word: str) -> int:
        """Pieces of a word; 0 for an empty one, -1 if the word can't be covered."""
        child, fail, popped = self.child, self.fail, self.popped
        node = total = 0
        for c in word:
            while c not in child[node]:
                if fail[node] < 0:
                    return -1
                total += popped[node]
                node = fail[node]
            node = child[node][c]
        while node > 1:
            if fail[node] < 0:
                return -1
            total += popped[node]
            node = fail[node]
        return total


@lru_cache(maxsize=4)
def load_pieces(model_file: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(pieces that begin a word, pieces that continue one) of a sentence-piece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return tuple(p[1:] for p in pieces if p.startswith(WORD_MARK)), tuple(p for p in pieces if not p.startswith(WORD_MARK))


@lru_cache(maxsize=4)
def automaton(model_file: str) -> LongestMatch:
    return LongestMatch(*load_pieces(model_file))


class _Counts(dict):
    """Pieces by word (UTF-8), worked out when first asked for."""

    def __init__(self, match: LongestMatch) -> None:
        self.match = match

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[word] = self.match.count(word.decode("utf-8", "replace"))
        return n


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, n_unknown) for each row of docs.

    Words are runs of characters outside ``\\x20\\x09-\\x0D``. n_tokens counts the pieces of all words of the whole
    text, with one token for each word that the vocabulary can't cover (n_unknown of them). Null and empty texts have
    0 of each. Ids may be null or repeat: there is one row for each row. Other columns are ignored. There is no
    shuffle; a task holds one Arrow batch and a bounded word cache.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(automaton(model_file))
        get = counts.__getitem__
        for batch in batches:
            rows = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(1)):
                found = list(map(get, (text.as_py() or b"").split()))
                unknown = found.count(-1)
                rows[:, i] = len(found), sum(found) + 2 * unknown, unknown
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)], ["id", "n_words", "n_tokens", "n_unknown"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return in_arrow(picked, run, f"id {kind}, n_words long, n_tokens long, n_unknown long").withColumnRenamed("id", id_col)
