"""Benchmark decontamination with SimHash windows (operator 7).

For each benchmark item, windows as long as the item slide over every document word by word. Window and item have a
128-bit SimHash of their word shingles. A multi-index over the fingerprints of the items of one length returns every item
within a Hamming radius: the bits are cut into radius + 1 blocks, and two fingerprints within the radius agree on one
block at least. What it returns is verified by the exact weighted Jaccard similarity of the shingles (weights:
occurrences). Two windows of similarity 0.8 differ in 19 bits on average (standard deviation 4), unrelated ones in 64;
the radius is 44.

A window of similarity t to an item has t times as many of that item's shingles as the item has; so windows with fewer
shingles that any item of the block has can't match anything, and aren't fingerprinted. Which item a window may match
is for the index alone to say.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.llm import shingles as S
from turnwright.llm.common import in_arrow
from turnwright.storage import scratch

BITS = 128
RADIUS = 44
#: Items are held by executors in blocks of at most so many characters; documents are read once for each block.
BLOCK_CHARS = 8_000_000
#: Windows that are fingerprinted at a time, and words that they lie within.
BATCH, SPAN = 4096, 1 << 16


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's 128-bit hash."""
    wide = np.stack((shingles, S.mix(shingles ^ S.BASE)), axis=1)
    return (np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").astype(np.int32) << 1) - 1


def bit_sums(shingles: np.ndarray) -> np.ndarray:
    """Running sums of the signs, from which any window's fingerprint is read off."""
    return np.concatenate((np.zeros((1, BITS), np.int32), np.cumsum(signs(shingles), axis=0, dtype=np.int32)))


def simhash(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints (rows of two words) of the windows of ``length`` shingles; a bit is set if more shingles have it
    than not."""
    return np.packbits(sums[starts + length] > sums[starts], axis=1, bitorder="little").view(np.uint64)


class HammingIndex:
    """Finds all fingerprints within ``radius`` of given ones."""

    #: Fingerprints up to which a query's blocks are compared with all of them at once instead of looked up.
    FEW = 64

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        self.edges = np.linspace(0, BITS, radius + 2).astype(int)[:-1]
        self.weights = (1 << (np.arange(BITS) - np.repeat(self.edges, np.diff([*self.edges, BITS])))).astype(np.uint32)
        self.values = self._blocks(prints)
        self.order = np.argsort(self.values, axis=0, kind="stable")
        self.ranked = np.take_along_axis(self.values, self.order, axis=0)

    def _blocks(self, prints: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little")
        return np.add.reduceat(bits * self.weights, self.edges, axis=1)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) of every pair within the radius, in that order."""
        asked = self._blocks(queries)
        if len(self.prints) <= self.FEW:
            found = (asked[:, None] == self.values[None]).any(axis=2)
        else:
            found = np.zeros((len(queries), len(self.prints)), bool)
            for block, values in enumerate(asked.T):
                a, b = (np.searchsorted(self.ranked[:, block], values, side) for side in ("left", "right"))
                row = np.repeat(np.arange(len(queries)), b - a)
                at = np.arange(len(row)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
                found[row, self.order[at, block]] = True
        q, f = np.nonzero(found)
        close = np.bitwise_count(queries[q] ^ self.prints[f]).sum(axis=1) <= self.radius
        return q[close], f[close]


def normal(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.fill_null(""))


class Group:
    """The items of one number of shingles, behind their index."""

    def __init__(self, items: list[int], shingles: list[np.ndarray]) -> None:
        self.items, self.length = items, len(shingles[0])
        self.counts = [Counter(s.tolist()) for s in shingles]
        self.index = HammingIndex(np.concatenate([simhash(bit_sums(s), np.zeros(1, np.int64), len(s)) for s in shingles]))


class Items:
    """The items of one block, ready for matching: by words of a shingle, then by shingles."""

    def __init__(self, ids: list, texts: list[str], k: int, least: float) -> None:
        self.ids, self.least = ids, least
        by_size: dict[int, dict[int, list[tuple[int, np.ndarray]]]] = {}
        for first, data, offsets in S.text_chunks(normal(pa.array(texts, pa.string()))):
            hashes, _, begins = S.words(data, offsets, S.MARKS)
            for i, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True), first):
                if b > a:
                    size = min(k, b - a)
                    own, _ = S.shingles(hashes[a:b], np.array([0, b - a]), size)
                    by_size.setdefault(size, {}).setdefault(len(own), []).append((i, own))
        #: words of a shingle: (all shingles of such items in order, groups by ascending length)
        self.sizes = {
            size: (np.unique(np.concatenate([s for some in groups.values() for _, s in some])), [Group([i for i, _ in groups[n]], [s for _, s in groups[n]]) for n in sorted(groups)])
            for size, groups in by_size.items()
        }

    def matches(self, shingles: np.ndarray, known: np.ndarray, groups: list[Group], size: int) -> Iterator[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window of each item that one text holds; ``known`` tells
        which of the text's shingles any item has."""
        held = np.concatenate(([0], np.cumsum(known)))
        hits = np.flatnonzero(known)
        low = max(0, int(hits[0]) - groups[-1].length)
        high = min(len(shingles), int(hits[-1]) + groups[-1].length)
        whole = bit_sums(shingles[low:high]) if high - low <= SPAN else None
        for group in groups:
            need = max(1, math.ceil(self.least * group.length - 1e-9))
            if need > held[-1] or need > len(shingles):
                continue
            n = min(group.length, len(shingles))  # a text shorter than the item is a window of its own
            starts = np.flatnonzero(held[n:] - held[:-n] >= need)
            best: dict[int, tuple[float, int]] = {}
            lo = 0
            while lo < len(starts):
                some = starts[lo : lo + BATCH]
                some = some[: np.searchsorted(some, some[0] + SPAN)]
                lo += len(some)
                if whole is not None and some[-1] + n <= high:
                    prints = simhash(whole, some - low, n)
                else:
                    prints = simhash(bit_sums(shingles[some[0] : some[-1] + n]), some - some[0], n)
                q, f = group.index.near(prints)
                last, window = -1, Counter()
                for at, j in zip(q.tolist(), f.tolist(), strict=True):
                    if at != last:
                        last, window = at, Counter(shingles[some[at] : some[at] + n].tolist())
                    item = group.counts[j]
                    inter = sum(min(c, item[x]) for x, c in window.items() if x in item)
                    sim = inter / (n + group.length - inter)
                    if sim >= self.least and (j not in best or sim > best[j][0]):
                        best[j] = (sim, int(some[at]))
            for j, (sim, start) in best.items():
                yield group.items[j], sim, start, n + size - 1

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, float, int, int]]]]:
        """(row, matches) for each text with matches."""
        for first, data, offsets in S.text_chunks(normal(texts)):
            hashes, _, begins = S.words(data, offsets, S.MARKS)
            found: dict[int, list] = {}
            for size, (known, groups) in self.sizes.items():
                shingles, begin = S.shingles(hashes, begins, size)
                at = np.searchsorted(known, shingles)
                at[at == len(known)] = 0
                hit = known[at] == shingles
                sums = np.concatenate(([0], np.cumsum(hit)))
                for row in np.flatnonzero((sums[begin[1:]] > sums[begin[:-1]]) & (np.diff(begins) >= size)).tolist():
                    a, b = int(begin[row]), int(begin[row + 1])
                    found.setdefault(row, []).extend(self.matches(shingles[a:b], hit[a:b], groups, size))
            for row in sorted(found):
                if found[row]:
                    yield first + row, sorted(found[row])


@lru_cache(maxsize=1)
def _items(uri: str, k: int, least: float) -> Items:
    """A block's items; a worker process makes them once for all its tasks."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f, pa.ipc.open_file(f) as reader:
        rows = reader.read_all()
    return Items(rows["item_id"].to_pylist(), rows["text"].to_pylist(), k, least)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Files of the items in ascending order of a hash, each of at most BLOCK_CHARS characters or one item, in the
    shared folder. The driver holds one block at a time."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    folder = scratch(benchmark.sparkSession, "items")
    fs, path = pafs.FileSystem.from_uri(folder)
    uris: list[str] = []

    def write(block: list) -> None:
        table = pa.table({"item_id": pa.array([r.item_id for r in block], pa.int64()), "text": pa.array([r.text for r in block], pa.large_string())})
        name = f"block-{len(uris):05d}.arrow"
        with fs.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_file(f, table.schema) as writer:
            writer.write_table(table)
        uris.append(f"{folder}/{name}")

    block, chars = [], 0
    for row in rows.orderBy(F.xxhash64("item_id", "text")).toLocalIterator():
        if block and chars + len(row.text) > BLOCK_CHARS:
            write(block)
            block, chars = [], 0
        block.append(row)
        chars += len(row.text)
    if block:
        write(block)
    return uris


def find_leaks(docs: DataFrame, benchmark: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): the best window of each item that a document holds.

    Words are lower-cased runs of letters and digits; an item of fewer than ``words`` words is one shingle, and one
    without words matches nothing. A text shorter than an item is compared with it as a whole. Null and empty texts
    hold nothing. Rows with equal ids each give their own rows, as do equal items; among windows of equal similarity the
    first is returned. An empty benchmark matches nothing. Other columns are ignored. Documents are not shuffled; a
    text of any length is worked through in memory that follows its length.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    out = docs.sparkSession.createDataFrame([], schema)
    for n, uri in enumerate(item_blocks(benchmark, item_col, item_text_col)):

        def run(batches: Iterator[pa.RecordBatch], uri: str = uri) -> Iterator[pa.RecordBatch]:
            items = _items(uri, words, least)
            for batch in batches:
                rows = [(batch.column(0)[row].as_py(), items.ids[j], *match) for row, found in items.scan(batch.column(1)) for j, *match in found]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in schema.split(", ")])

        found = in_arrow(base, run, schema)
        out = out.unionByName(found) if n else found
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, words: int = 5, least: float = 0.8, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item, with all their columns. Rows are judged where they lie, without a shuffle;
    null and repeated ids don't matter, and an empty benchmark leaves every row."""
    column = docs.columns.index(text_col)
    for uri in item_blocks(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], uri: str = uri) -> Iterator[pa.RecordBatch]:
            items = _items(uri, words, least)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, _ in items.scan(batch.column(column)):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = in_arrow(docs, run, docs.schema)
    return docs


#: Every window of every item's length that shares shingles enough with it, by exact weighted similarity.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT *, least(5, len(ws)) AS k, len(ws) - least(5, len(ws)) + 1 AS n FROM b WHERE len(ws) > 0),
ig AS (SELECT iid, item_id, k, n, array_to_string(ws[p + 1:p + k], ' ') AS g, count(*) AS c FROM (SELECT *, unnest(range(0, n)) AS p FROM i) GROUP BY ALL),
dg AS (SELECT rid, doc_id, k, len(ws) - k + 1 AS m, p, array_to_string(ws[p + 1:p + k], ' ') AS g
       FROM (SELECT *, unnest(range(0, len(ws) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM i) WHERE len(ws) >= k)),
h AS (SELECT rid, doc_id, iid, item_id, m, n, least(m, n) AS size, dg.k, p, dg.g, c FROM dg JOIN ig ON dg.k = ig.k AND dg.g = ig.g),
o AS (SELECT rid, iid, any_value(size) AS size, unnest(range(0, any_value(m - size) + 1)) AS s FROM h GROUP BY rid, iid HAVING count(*) >= 0.8 * any_value(n) - 1e-9),
x AS (SELECT o.rid, doc_id, o.iid, item_id, s, n, o.size, k, g, least(count(*), any_value(c)) AS shared
      FROM o JOIN h ON o.rid = h.rid AND o.iid = h.iid AND p >= s AND p < s + o.size GROUP BY ALL),
y AS (SELECT rid, doc_id, iid, item_id, s, size, k, CAST(sum(shared) AS DOUBLE) / CAST(size + n - sum(shared) AS DOUBLE) AS similarity FROM x GROUP BY rid, doc_id, iid, item_id, s, n, size, k),
z AS (SELECT *, row_number() OVER (PARTITION BY rid, iid ORDER BY similarity DESC, s) AS nth FROM y WHERE similarity >= 0.8)
SELECT doc_id, item_id, similarity, s AS start_word, size + k - 1 AS n_words FROM z WHERE nth = 1
"""
