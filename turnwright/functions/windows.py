"""Windows of texts by rolling hashes, in numpy over Arrow batches.

Every window of a text is looked at, and a built-in substring walks from the text's start and makes a string for each;
here a window's hash is the difference of two prefix sums. Sets of hashes are written to the shared folder, and each
worker reads them into sorted arrays; a set of more than MOST members is read a range of hashes at a time, in as many
passes over the texts. So tables that grow let no more of the other windows through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.storage import scratch

#: Code points that are worked on at a time; so few that the arrays stay in a core's cache.
CHUNK = 1 << 18
#: Members of a set of hashes that a worker holds at a time, 8 or 16 bytes each.
MOST = 1 << 24
#: Windows are counted by the upper 42 bits of their hashes: 10 say the part, 32 are shuffled.
PARTS, SHIFT = 1 << 10, np.uint64(22)
OWN = np.uint64(64) - SHIFT  # those bits; the others have room for a batch's groups
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1)."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        _powers[int(base)] = known = np.cumprod(known)
    return known[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class Joined:
    """Texts end to end, and hashes of any of their windows."""

    def __init__(self, texts: Sequence[str]) -> None:
        self.text = "".join(texts)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        self.begins = np.concatenate(([0], self.ends[:-1])) if len(texts) else self.ends
        self.codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes.astype(np.uint64) + np.uint64(1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * _power(BASE, len(codes)), dtype=np.uint64)))

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        return _mixed((self.sums[at + size] - self.sums[at]) * _power(INVERSE, len(self.sums))[at] + np.uint64(size))

    def all_hashes(self, size: int) -> np.ndarray:
        """Those of the windows from each place on, whether they cross texts' ends or not."""
        n = max(0, len(self.sums) - size)
        x = self.sums[size:] - self.sums[:n]
        x *= _power(INVERSE, len(self.sums))[:n]
        x += np.uint64(size)
        return _mixed(x)

    def second_hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Others, which do not depend on the first: a factor of its own for each place in the window."""
        x = np.full(len(at), size, np.uint64)
        for i, factor in enumerate(np.random.default_rng(size).integers(0, 1 << 64, size, np.uint64).tolist()):
            x += self.codes[at + i] * np.uint64(factor | 1)
        return _mixed(x)

    def heads(self, at: np.ndarray) -> np.ndarray:
        """The windows' first three code points as a number of the same order."""
        a, b, c = (self.codes[at + i].astype(np.uint64) for i in range(3))
        return a << np.uint64(42) | b << np.uint64(21) | c


def _chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) of at most CHUNK code points, or of one text."""
    first, part, held = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if part and held + len(t) > CHUNK:
            yield first, part
            first, part, held = i, [], 0
        part.append(t)
        held += len(t)
    if part:
        yield first, part


def _spread(begins: np.ndarray, counts: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of counts[i] places from begins[i] on, steps[i] apart."""
    owner = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, begins[owner] + nth * steps[owner]


Starts = Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray]]
#: What makes a body of a text, or None to leave the row out.
Clean = Callable[[str], str | None]


def windows(texts: Sequence[str | None], sizes: Sequence[int], starts: Starts) -> Iterator[tuple[np.ndarray, Joined, np.ndarray, int]]:
    """(text, joined texts, place in them, size) of the windows of each size, chunk by chunk."""
    for first, part in _chunks(texts):
        for size in sizes:
            counts, steps = starts(np.fromiter(map(len, part), np.int64, len(part)), size)
            if len(part) == 1 and len(part[0]) > CHUNK:  # a very long text, some of its windows at a time
                for lo in range(0, int(counts[0]), CHUNK if steps[0] == 1 else CHUNK // size):
                    if steps[0] == 1:
                        hi = min(int(counts[0]), lo + CHUNK)
                        joined, at = Joined([part[0][lo : hi - 1 + size]]), np.arange(hi - lo)
                    else:
                        joined = Joined([part[0][i * steps[0] : i * steps[0] + size] for i in range(lo, min(int(counts[0]), lo + CHUNK // size))])
                        at = joined.begins
                    yield np.full(len(at), first), joined, at, size
                continue
            joined = Joined(part) if size == sizes[0] else joined
            owner, at = _spread(joined.begins, counts, steps)
            yield first + owner, joined, at, size


def _joined(texts: Sequence[str | None], size: int) -> Iterator[tuple[int, Joined]]:
    """(index of the first, joined texts), a very long text in pieces that share size - 1 code points."""
    for first, part in _chunks(texts):
        if len(part) == 1 and len(part[0]) > CHUNK:
            for lo in range(0, len(part[0]), CHUNK):
                yield first, Joined([part[0][lo : lo + CHUNK + size - 1]])
        else:
            yield first, Joined(part)


def _bodies(column: pa.Array, clean: Clean | None) -> tuple[list[str | None], np.ndarray]:
    """(bodies of the rows that have one, their rows)."""
    texts = column.to_pylist()
    if clean is None:
        return texts, np.arange(len(texts))
    texts = [None if t is None else clean(t) for t in texts]
    rows = [i for i, t in enumerate(texts) if t is not None]
    return [texts[i] for i in rows], np.array(rows, np.int64)


def _grouped(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, pa.RecordBatch]:
    """(number of each row's group by the first n columns, a row of them for each group)."""
    if not n:
        return np.zeros(batch.num_rows, np.int64), batch.select([]).slice(0, 1)
    names = batch.schema.names[:n]
    code = np.zeros(batch.num_rows, np.int64)
    for i in range(n):
        own = batch.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy()
        code = np.unique(code * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1]
    _, where = np.unique(code, return_index=True)
    return code, batch.select(names).take(pa.array(where))


def _schema(df: DataFrame, keep: Sequence[str], *more: T.StructField) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keep), *more])


def _bytes(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """(offsets, data) of a binary column."""
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1], memoryview(column.buffers()[2] or b"")


def _blocks(texts: DataFrame, keep: Sequence[str], sizes: Sequence[int], starts: Starts, least: Sequence[int], clean: Clean | None = None) -> DataFrame:
    """(keep, part, n, keys): the windows of each batch by part, each as the 32 bits after those that say the part, none
    more often than its size's least; with part -1, the number of texts."""
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            group, rows = _grouped(batch, n_keep)
            groups = rows.num_rows if n_keep else 1
            own, own_rows = _bodies(batch.column(n_keep), clean)
            group = group[own_rows]
            found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in sizes]
            for owner, joined, at, size in windows(own, sizes, starts):
                found[sizes.index(size)].append((group[owner], joined.hashes(at, size) >> SHIFT))
            whose, parts, ends, data = [np.arange(groups)], [np.full(groups, -1)], [np.zeros(groups, np.int64)], []
            for s, pieces in enumerate(found):
                if not pieces:
                    continue
                g, key = (np.concatenate(x) for x in zip(*pieces, strict=True))
                both = np.sort(g.astype(np.uint64) << OWN | key)
                g, key = (both >> OWN).view(np.int64), both & ((np.uint64(1) << OWN) - np.uint64(1))
                new = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])))) if len(key) else np.zeros(0, np.int64)
                few = np.arange(len(key)) - np.repeat(new, np.diff(np.concatenate((new, [len(key)])))) < least[s]
                g, key = g[few], key[few]
                block = g * PARTS + (key >> np.uint64(32)).view(np.int64)
                last = np.flatnonzero(np.concatenate((block[1:] != block[:-1], [True]))) if len(block) else np.zeros(0, np.int64)
                whose.append(block[last] // PARTS)
                parts.append(s * PARTS + block[last] % PARTS)
                ends.append((last + 1) * 4 + ends[-1][-1])
                data.append(key.astype(np.uint32))
            at = pa.array(np.concatenate(whose))
            n = np.where(np.concatenate(parts) < 0, np.bincount(group, minlength=groups)[np.concatenate(whose)], 0)
            keys = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.concatenate(([0], *ends)).astype(np.int32)), pa.py_buffer(np.concatenate([np.zeros(0, np.uint32), *data]))])
            yield pa.RecordBatch.from_arrays([*(rows.column(i).take(at) for i in range(n_keep)), pa.array(np.concatenate(parts).astype(np.int32)), pa.array(n), keys], [*keep, "part", "n", "keys"])

    return texts.select(*keep, "body").mapInArrow(run, _schema(texts, keep, *BLOCK))


BLOCK = (T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("keys", T.BinaryType()))


def _frequent(blocks: DataFrame, keep: Sequence[str], least: Sequence[int]) -> DataFrame:
    """The same with each part's keys that there are the least times, once each; its rows come one after the other."""
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, texts, schema = None, [], 0, None

        def done() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint32)
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
            often = keys[new[np.diff(np.concatenate((new, [len(keys)]))) >= least[max(now[-1], 0) // PARTS]]]
            return pa.RecordBatch.from_pylist([dict(zip([*keep, "part", "n", "keys"], [*now, texts, often.tobytes()], strict=True))], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            schema, part, n = batch.schema, batch.column(n_keep).to_numpy(), batch.column(n_keep + 1).to_numpy()
            offsets, data = _bytes(batch.column(n_keep + 2))
            group = _grouped(batch, n_keep)[0]
            new = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (group[1:] != group[:-1]))))
            for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(part)], strict=True):
                own = (*(batch.column(i)[lo].as_py() for i in range(n_keep)), int(part[lo]))
                if now is not None and own != now:
                    yield done()
                    held, texts = [], 0
                now = own
                texts += int(n[lo:hi].sum())
                held.append(np.frombuffer(data[offsets[lo] : offsets[hi]], np.uint32).copy())
        if now is not None:
            yield done()

    together = blocks.repartition(*keep, "part").sortWithinPartitions(*keep, "part")
    return together.mapInArrow(run, _schema(blocks, keep, *BLOCK))


@dataclass(frozen=True)
class Hashes:
    """A set of hashes in a folder, and the range of their upper 10 bits that is looked at."""

    folder: str
    low: int = 0
    high: int = PARTS

    def ranges(self, n: int) -> list[Hashes]:
        """In ranges of at most about MOST, if there are n; none if there are none."""
        cuts = np.linspace(0, PARTS, min(PARTS, -(-n // MOST)) + 1).astype(int).tolist() if n else []
        return [Hashes(self.folder, a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


class Members:
    """The members of a set in order, with second hashes where there are some. A bit map of 16 to 32 bits a member keeps
    most others from being searched for."""

    def __init__(self, first: np.ndarray, second: np.ndarray | None = None) -> None:
        order = np.argsort(first)
        self.first, self.second = first[order], None if second is None else second[order]
        self.shift = np.uint64(64 - max(6, int(16 * len(first)).bit_length()))
        bit = (self.first >> self.shift).view(np.int64)
        self.bits = np.zeros((1 << (64 - int(self.shift))) // 8, np.uint8)
        if len(bit):
            new = np.flatnonzero(np.concatenate(([True], bit[1:] >> 3 != bit[:-1] >> 3)))
            self.bits[bit[new] >> 3] = np.bitwise_or.reduceat(np.left_shift(1, bit & 7).astype(np.uint8), new)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of h are members, their places here), in the order of h."""
        bit = (h >> self.shift).view(np.int64)
        maybe = np.flatnonzero((self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
        if not len(maybe) or not len(self.first):
            return maybe[:0], maybe[:0]
        order = np.argsort(h[maybe])
        place = np.empty(len(maybe), np.int64)
        place[order] = np.searchsorted(self.first, h[maybe[order]])
        place = np.minimum(place, len(self.first) - 1)
        here = self.first[place] == h[maybe]
        return maybe[here], place[here]


_members: dict[Hashes, Members] = {}


def _read(hashes: Hashes) -> Members:
    """The set, read once by each worker, which holds the last one only."""
    if hashes not in _members:
        _members.clear()
        fs, path = pafs.FileSystem.from_uri(hashes.folder)
        first, second = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for info in fs.get_file_info(pafs.FileSelector(path)):
            if not info.base_name.endswith(".parquet"):
                continue
            with fs.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches():
                    if "keys" in batch.schema.names:
                        offsets, data = _bytes(batch["keys"])
                        for i, part in enumerate(batch["part"].to_pylist()):
                            if part >= 0 and hashes.low <= part % PARTS < hashes.high:
                                keys = np.frombuffer(data[offsets[i] : offsets[i + 1]], np.uint32).astype(np.uint64)
                                first.append((keys | np.uint64(part % PARTS << 32)) << SHIFT)
                    else:
                        h = batch["h"].to_numpy().view(np.uint64)
                        here = (h >> np.uint64(54)).view(np.int64)
                        here = (here >= hashes.low) & (here < hashes.high)
                        first.append(h[here])
                        second.append(batch["second"].to_numpy().view(np.uint64)[here])
        one, two = np.concatenate(first), np.concatenate(second)
        del first, second
        _members[hashes] = Members(one, two if len(two) else None)
    return _members[hashes]


def frequent_hashes(texts: DataFrame, keep: Sequence[str], sizes: Sequence[int], starts: Starts, least: Sequence[int], clean: Clean | None = None) -> tuple[list[Hashes], DataFrame]:
    """(sets of the upper bits of windows' hashes that a group of keep has as often as their size's least, (keep, n) of
    texts). Of each window four bytes are shuffled."""
    spark = texts.sparkSession
    folder = f"{scratch(spark, 'hashes')}/found"
    _frequent(_blocks(texts, keep, sizes, starts, least, clean), keep, least).write.parquet(folder)
    found = spark.read.schema(_schema(texts, keep, *BLOCK)).parquet(folder)
    n = found.agg(F.coalesce(F.sum(F.length("keys")), F.lit(0))).first()[0] // 4
    return Hashes(folder).ranges(n), found.where("part < 0").groupBy(*keep).agg(F.sum("n").alias("n"))


def text_hashes(texts: DataFrame, column: str, group: str) -> list[Hashes]:
    """Sets of the hashes of texts as windows of their own lengths, within a group (bigint)."""
    spark = texts.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, whose = batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64)
            joined, out = Joined(own), np.zeros((2, len(own)), np.uint64)
            sizes = joined.ends - joined.begins
            for size in np.unique(sizes).tolist():
                at = joined.begins[sizes == size]
                out[:, sizes == size] = joined.hashes(at, size), joined.second_hashes(at, size)
            yield pa.RecordBatch.from_arrays([pa.array(_mixed(out[0] ^ whose).view(np.int64)), pa.array(out[1].view(np.int64))], ["h", "second"])

    folder = f"{scratch(spark, 'hashes')}/found"
    texts.select(column, group).mapInArrow(run, "h long, second long").write.parquet(folder)
    return Hashes(folder).ranges(spark.read.schema("h long, second long").parquet(folder).count())


def window_texts(texts: DataFrame, keep: Sequence[str], sizes: Sequence[int], starts: Starts, hashes: Hashes | None, clean: Clean | None = None) -> DataFrame:
    """(keep, sig, n): the windows whose hashes' upper bits the set has (all, without one), counted in each batch."""
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = None if hashes is None else _read(hashes)
        for batch in batches:
            if not batch.num_rows:
                continue
            group, rows = _grouped(batch, n_keep)
            own, own_rows = _bodies(batch.column(n_keep), clean)
            group = group[own_rows]
            found: Counter = Counter()
            for owner, joined, at, size in windows(own, sizes, starts):
                if members is not None:
                    here = members.find(joined.hashes(at, size) >> SHIFT << SHIFT)[0]
                    owner, at = owner[here], at[here]
                found.update((g, joined.text[a : a + size]) for g, a in zip(group[owner].tolist(), at.tolist(), strict=True))
            where = pa.array([g for g, _ in found], pa.int64())
            kept = [rows.column(i).take(where) for i in range(n_keep)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([t for _, t in found], pa.string()), pa.array(found.values(), pa.int64())], [*keep, "sig", "n"])

    return texts.select(*keep, "body").mapInArrow(run, _schema(texts, keep, T.StructField("sig", T.StringType()), T.StructField("n", T.LongType())))


def best_windows(texts: DataFrame, key: Sequence[str], group: str, sizes: Sequence[int], hashes: Hashes, clean: Clean | None = None) -> DataFrame:
    """(key, sig): of each row's windows in the set, by both hashes, those of the first size that has one, and of them the
    first in code-point order. Rows that hold none are left out."""
    n_key = len(key)

    def best(texts: Sequence[str | None], whose: np.ndarray, members: Members) -> dict[int, str]:
        found: dict[int, str] = {}
        level = np.full(len(texts), len(sizes))  # the size that a row has one of
        for first, joined in _joined(texts, max(sizes)):
            salt = np.repeat(whose[first : first + len(joined.ends)], joined.ends - joined.begins)
            for k, size in enumerate(sizes):
                h = joined.all_hashes(size)
                at, place = members.find(_mixed(h ^ salt[: len(h)]))
                owner = np.searchsorted(joined.ends, at, side="right")
                fits = (at + size <= joined.ends[owner]) & (k <= level[first + owner])
                at, place, owner = at[fits], place[fits], first + owner[fits]
                sure = members.second[place] == joined.second_hashes(at, size) if len(at) else at
                owner, at = owner[sure], at[sure]
                if not len(owner):
                    continue
                head, new = joined.heads(at), np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                least = np.repeat(np.minimum.reduceat(head, new), np.diff(np.concatenate((new, [len(owner)])))) == head
                for i in owner[new][k < level[owner[new]]].tolist():
                    found.pop(i, None)
                level[owner] = k
                for i, a in zip(owner[least].tolist(), at[least].tolist(), strict=True):
                    text = joined.text[a : a + size]
                    if i not in found or text < found[i]:
                        found[i] = text
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = _read(hashes)
        for batch in batches:
            own, own_rows = _bodies(batch.column(n_key + 1), clean)
            found = best(own, batch.column(n_key).to_numpy().view(np.uint64)[own_rows], members)
            at = pa.array(own_rows[list(found)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(n_key)), pa.array(found.values(), pa.string())], [*key, "sig"])

    return texts.select(*key, group, "body").mapInArrow(run, _schema(texts, key, T.StructField("sig", T.StringType())))
