"""Near-duplicate vectors by a robust-pruned flat graph (operator 6).

Vectors are clustered into shards, level by level until a shard is small; a vector is at home with its nearest centroid
and a guest of every other shard whose plane is nearer than a margin, so shards overlap. Each shard builds a graph:
robust pruning keeps a neighbour unless a nearer one kept leads to it. The adjacency lists that a vector has in its
shards are united. Each vector then searches its home shard by the united lists: greedily from the shard's medoid, then
by expanding every node within a range wider than the links', the vector's own node among them. What is found is
verified in double precision. A shard too dense to part is worked through in tiles of all pairs.

Two linked vectors at home in different shards lie on either side of a plane, at distances that add up to the
displacement's part across it; so one of them is within half the link radius of the plane. With that margin no link is
lost between shards. Where the data have many directions far less is enough: a displacement of the link radius has a part
across a given plane of about the radius by the square root of their number, and the margin is half of SIGMAS times that,
or half the radius if that is less. A link counts once, in one of the two homes, for both of its ends.

Recall is audited against all vectors for sampled vectors with and without links. Below the floor the margin becomes
half the radius and the search wider; if that does not do, every pair that the link radius allows is tested.
"""

from __future__ import annotations

import math
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.llm import shingles as S
from turnwright.llm.common import connected_components, grouped, map_arrow
from turnwright.storage import cut, scratch

#: Rows of a shard, on average, and rows from which a shard is split again.
SHARD, SPLIT = 1000, 6000
#: Rows that the centroids of one shard are fitted on, centroids of one shard at most, and levels at most.
FIT_ROWS, CELLS, LEVELS = 8192, 256, 6
#: Shards whose table (a narrow row each) goes to all executors at most.
FEW = 500_000
#: Rows of a block of a shard that can't be split.
TILE = 4096
#: Pairs that a task looks at at a time.
PAIRS = 1 << 22
#: Directions of a margin, in standard deviations.
SIGMAS = 3.5
DEGREE, NEAREST, RANDOM = 20, 32, 32
ALPHA = 1.2
#: Nodes that a search expands at least on its way, and vectors of an audit from those with links and from all.
EFFORT, AUDIT = 24, 256
#: The exhaustive search: rows of a block at least and at most, bytes of a block at most, blocks wanted if that allows it.
BLOCK_LEAST, BLOCK, BLOCK_BYTES, BLOCKS = 2000, 8000, 16 << 20, 6


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _stack(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    """Vectors (bytes of their own type) as float64 rows of one width, as all of a shard have one length."""
    rows = [np.frombuffer(x.as_buffer(), kind).astype(np.float64) for x in column]
    return np.stack(rows) if rows else np.zeros((0, 0))


def centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means of unit rows, from evenly spaced starts."""
    k = max(1, min(k, len(sample)))
    c = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(8):
        own = (sample @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1)
        c[size > 0] = sums[size > 0] / size[size > 0, None]
    return np.unique(c, axis=0)


def _pruned(v: np.ndarray, own: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The neighbours that robust pruning keeps, nearest first, for the nodes ``own``: of the nearest ones and of some
    at random, one at a time the nearest left, which rules out what it is ALPHA times nearer to than the node is."""
    n, m = len(v), len(own)
    sims = v[own] @ v.T
    sims[np.arange(m), own] = -2
    near = min(NEAREST, n - 1)
    candidates = np.argpartition(-sims, near - 1, axis=1)[:, :near]
    candidates = np.concatenate((candidates, rng.integers(0, n, (m, RANDOM))), axis=1)
    at = np.arange(m)[:, None]
    s = sims[at, candidates]
    order = np.argsort(-s, axis=1, kind="stable")
    candidates, s = candidates[at, order], s[at, order]
    live = s > -2
    live[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    distance, places = np.maximum(2 - 2 * s, 0), v[candidates]
    kept = np.full((m, DEGREE), -1)
    for r in range(DEGREE):
        some = live.any(1)
        if not some.any():
            break
        pick = live.argmax(1)
        p = candidates[np.arange(m), pick]
        kept[some, r] = p[some]
        live[np.arange(m), pick] = False
        live &= ~(ALPHA**2 * np.maximum(2 - 2 * np.einsum("ijk,ik->ij", places, v[p]), 0) <= distance)
    return kept


def build_graph(vectors: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Robust-pruned adjacency of one shard's unit vectors, in both directions; every node can be reached from the
    medoid."""
    n = len(vectors)
    if n == 1:
        return [np.zeros(0, np.int64)]
    v = vectors.astype(np.float32)
    rng = np.random.Generator(np.random.PCG64(seed))
    kept = np.full((n, DEGREE), -1)
    step = max(64, min(1024, (1 << 22) // n))
    for lo in range(0, n, step):
        kept[lo : lo + step] = _pruned(v, np.arange(lo, min(n, lo + step)), rng)
    out = [set(row[row >= 0].tolist()) for row in kept]
    for i, row in enumerate(kept):
        for j in row[row >= 0].tolist():
            out[j].add(i)
    root = medoid(vectors)
    seen = np.zeros(n, bool)

    def reach(node: int) -> None:
        todo = [node]
        seen[node] = True
        while todo:
            for j in out[todo.pop()]:
                if not seen[j]:
                    seen[j] = True
                    todo.append(j)

    reach(root)
    for i in range(n):
        if not seen[i]:
            out[root].add(i)
            reach(i)
    return [np.array(sorted(x), np.int64) for x in out]


def medoid(vectors: np.ndarray) -> int:
    return int((vectors @ vectors.mean(0)).argmax())


def link_radius(least: float) -> float:
    """The distance of two unit vectors of cosine ``least``."""
    return math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9


def margin(sample: np.ndarray, least: float) -> float:
    """How near a plane makes a vector a guest of the shard behind it, from the directions that a sample has."""
    spread = np.linalg.eigvalsh(np.cov(sample.T)) if len(sample) > 1 and sample.shape[1] > 1 else np.ones(1)
    directions = max(1.0, spread.sum() ** 2 / max((spread**2).sum(), 1e-30))
    return link_radius(least) / 2 * min(1.0, SIGMAS / math.sqrt(directions))


def _fit(kind: str, folder: str, least: float, wide: bool):
    """Centroids of one shard from a sample of its rows, in a file; none if they would not part it."""

    def work(rows: pa.Table) -> pa.Table:
        leaf, n = rows["leaf"][0].as_py(), rows["n"][0].as_py()
        order = np.argsort(rows["cid"].to_numpy(), kind="stable")
        v = unit(_stack(rows["vec"].take(pa.array(order)), kind))
        cells = centroids(v, min(CELLS, -(-n // SHARD)))
        limit = link_radius(least) / 2 if wide else margin(v, least)
        uri = None
        if len(cells) > 1:
            shards = _shards_of(v, cells, limit)
            largest = np.bincount(np.concatenate([np.array(x) for x in shards]), minlength=len(cells)).max()
            if largest <= 0.7 * len(v) and sum(map(len, shards)) <= 0.5 * len(cells) * len(v) + len(v):
                uri = f"{folder}/{leaf}-{uuid.uuid4().hex}.npy"
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_output_stream(path) as f:
                    np.save(f, cells)
        return pa.table({"leaf": pa.array([leaf], pa.int64()), "uri": pa.array([uri], pa.string()), "limit": pa.array([limit], pa.float64())})

    return work


def _shards_of(v: np.ndarray, cells: np.ndarray, limit: float) -> list[list[int]]:
    """The shards of each unit vector, its home first."""
    gaps = np.linalg.norm(cells[:, None] - cells[None], axis=2)
    sims = v @ cells.T
    at, best = np.arange(len(v)), sims.argmax(1)
    gap = np.where(gaps[best] > 0, gaps[best], np.inf)
    near = (sims[at, best][:, None] - sims) / gap <= limit  # distance to the plane between home and each other centroid
    near[at, best] = False
    return [[int(b), *np.flatnonzero(row).tolist()] for b, row in zip(best, near, strict=True)]


@lru_cache(maxsize=64)
def _cells(uri: str) -> np.ndarray:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return np.load(pa.BufferReader(f.read()))


@lru_cache(maxsize=1 << 16)
def _child(leaf: int, cell: int) -> int:
    """A number for a shard's part: a hash of 64 bits of its path."""
    with np.errstate(over="ignore"):
        mixed = S.mix(np.array([leaf], np.int64).view(np.uint64) * S.BASE + np.uint64(cell + 1))
    return int(mixed.view(np.int64)[0])


def _few(df: DataFrame) -> DataFrame:
    """A table of a row a shard, kept; to all executors if it is counted to be small."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= FEW else df


def _deal(kind: str):
    """A row for each shard of each vector: (leaf, home, cid, vec)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf, home, cid = (batch.column(i).to_pylist() for i in range(3))
        uri, limit = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        out: list[tuple[int, bool, int, int]] = []
        for name in dict.fromkeys(uri):
            own = [i for i, u in enumerate(uri) if u == name]
            v = unit(_stack(batch.column(3).take(pa.array(own)), kind))
            for i, shards in zip(own, _shards_of(v, _cells(name), limit[own[0]]), strict=True):
                out += [(_child(leaf[i], c), home[i] and k == 0, cid[i], i) for k, c in enumerate(shards)]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.bool_()), pa.array([x[2] for x in out], pa.int64()), batch.column(3).take(pa.array([x[3] for x in out], pa.int64()))], ["leaf", "home", "cid", "vec"])

    return work


def shards(classes: DataFrame, least: float, kind: str, wide: bool) -> DataFrame:
    """(leaf, home, cid) of all classes, split level by level; vectors of each length have a root of their own."""
    root = F.xxhash64(F.octet_length("vec"))
    rows = classes.select(root.alias("leaf"), F.lit(True).alias("home"), "cid", "vec")
    folder = scratch(classes.sparkSession, "cells")
    done = None
    for _ in range(LEVELS):
        large = _few(rows.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > (SPLIT if done is not None else SHARD)))
        if large.isEmpty():
            break
        share = F.least(F.lit(1.0), F.lit(float(FIT_ROWS)) / F.col("n"))
        drawn = F.pmod(F.xxhash64("cid", F.lit("fit")), F.lit(1 << 30)) < share * (1 << 30)
        sample = rows.join(large, "leaf").where(drawn).select("leaf", "n", "cid", "vec")
        fitted = _few(sample.groupBy("leaf").applyInArrow(grouped(_fit(kind, folder, least, wide)), "leaf long, uri string, limit double").where("uri is not null"))
        parted = rows.join(fitted, "leaf").select("leaf", "home", "cid", "vec", "uri", "limit")
        rest = rows.join(fitted, "leaf", "left_anti")
        rest = rest.select("leaf", "home", "cid")
        done = cut(rest if done is None else done.unionByName(rest))
        rows = cut(map_arrow(parted, "leaf long, home boolean, cid long, vec binary", _deal(kind)))
    rows = rows.select("leaf", "home", "cid")
    return rows if done is None else done.unionByName(rows)


def search(vectors: np.ndarray, starts: np.ndarray, targets: np.ndarray, asked: np.ndarray, least: float, effort: int) -> tuple[np.ndarray, np.ndarray]:
    """(asked row, node) of what the search from the nodes ``asked`` meets within a little of the range.

    A node's neighbours are targets[starts[node] : starts[node + 1]]. From the medoid each query expands the best node
    met, ``effort`` times, and then, level by level, every node within the wider range: its own, and those that a pruned
    link may lead through.
    """
    n, q = len(vectors), len(asked)
    v = vectors.astype(np.float32)
    w = v[asked]
    met = np.full((q, n), -2, np.float32)
    done = np.zeros((q, n), bool)

    def expand(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours not met yet, each once, now met."""
        sizes = starts[nodes + 1] - starts[nodes]
        at = np.arange(sizes.sum()) + np.repeat(starts[nodes] - (np.cumsum(sizes) - sizes), sizes)
        rows, nbrs = np.repeat(rows, sizes), targets[at]
        new = met[rows, nbrs] == -2
        flat = np.unique(rows[new] * n + nbrs[new])
        rows, nbrs = flat // n, flat % n
        for lo in range(0, len(rows), 100_000):
            x, y = rows[lo : lo + 100_000], nbrs[lo : lo + 100_000]
            met[x, y] = np.einsum("ij,ij->i", w[x], v[y])
        return rows, nbrs

    root = medoid(vectors)
    met[:, root] = w @ v[root]
    open_ = met.copy()
    rows = np.arange(q)
    for _ in range(min(effort, n)):
        best = open_[rows].argmax(1)
        alive = open_[rows, best] > -2
        rows, best = rows[alive], best[alive]
        if not len(rows):
            break
        done[rows, best] = True
        open_[rows, best] = -2
        x, y = expand(rows, best)
        open_[x, y] = met[x, y]
    del open_
    met[np.arange(q), asked] = 1
    # a node that leads to a link lies within (1 + 1 / ALPHA) times the radius, by the rule of pruning
    wider = 1 - (link_radius(least) * (1 + 1 / ALPHA)) ** 2 / 2
    while True:
        r, t = np.nonzero((met >= wider) & ~done)
        if not len(r):
            break
        for lo in range(0, len(r), 20_000):
            done[r[lo : lo + 20_000], t[lo : lo + 20_000]] = True
            expand(r[lo : lo + 20_000], t[lo : lo + 20_000])
    return np.nonzero(met >= least - 1e-3)


def _build(kind: str):
    """The graph of one shard: (cid, neighbours)."""

    def work(rows: pa.Table) -> pa.Table:
        ids = rows["cid"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        graph = build_graph(unit(_stack(rows["vec"].take(pa.array(order)), kind)), rows["leaf"][0].as_py() & 0xFFFFFFFF)
        sizes = np.array([len(x) for x in graph])
        flat = ids[np.concatenate(graph)] if sizes.sum() else np.zeros(0, np.int64)
        return pa.table({"cid": pa.array(ids), "nbrs": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, pa.int64()))})

    return work


class Links:
    """Adds up the links that the rows of one shard are found to have, some pairs at a time."""

    def __init__(self, rows: pa.Table, v: np.ndarray, least: float) -> None:
        self.v, self.least = v, least
        self.ids, self.mult, self.home = (rows[c].to_numpy() for c in ("cid", "mult", "homeleaf"))
        self.leaf, leaves = rows["leaf"][0].as_py(), rows["leaves"].to_pylist()
        places, self.place = np.unique(self.home, return_inverse=True)
        flat = np.array([p for some in leaves for p in some], np.int64)
        at = np.searchsorted(places, flat)
        at[at == len(places)] = 0
        here = places[at] == flat
        #: Is the row in the shard where another one is at home?
        self.guest = np.zeros((len(self.ids), len(places)), bool)
        self.guest[np.repeat(np.arange(len(self.ids)), [len(some) for some in leaves])[here], at[here]] = True
        self.total, self.label, self.edges = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids)), []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """The pairs (x at home here, y) that are links, as far as they are counted here.

        Two that are both at home here count from the smaller id. If y is at home elsewhere and x a guest there, the
        pair is met there as well, and counts in the shard of the smaller number.
        """
        keep = np.where(self.home[y] == self.leaf, self.ids[x] < self.ids[y], (self.home[y] > self.leaf) | ~self.guest[x, self.place[y]])
        x, y = x[keep], y[keep]
        exact = np.empty(len(x))
        for lo in range(0, len(x), 100_000):
            exact[lo : lo + 100_000] = np.einsum("ij,ij->i", self.v[x[lo : lo + 100_000]], self.v[y[lo : lo + 100_000]])
        x, y = x[exact >= self.least], y[exact >= self.least]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        np.add.at(self.total, x, self.mult[y])
        np.add.at(self.total, y, self.mult[x])
        self.edges += _join(self.label, x, y)

    def table(self) -> pa.Table:
        return _found(self.ids, self.total, self.edges)


def _found(ids: np.ndarray, total: np.ndarray, edges: list[tuple[int, int]]) -> pa.Table:
    """Rows (a, null, n): n vectors linked with class a; and rows (a, b, 0): edges that connect the linked classes."""
    met = np.flatnonzero(total)
    ends = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({
        "a": pa.array(np.concatenate((ids[met], ids[ends[:, 0]])), pa.int64()),
        "b": pa.array(np.concatenate((np.zeros(len(met), np.int64), ids[ends[:, 1]])), pa.int64(), mask=np.arange(len(met) + len(ends)) < len(met)),
        "n": pa.array(np.concatenate((total[met], np.zeros(len(ends), np.int64))), pa.int64()),
    })


def _search_shard(least: float, effort: int, kind: str):
    """Links of the vectors at home in a shard, by its graph."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows["cid"].to_numpy(), kind="stable")))
        ids = rows["cid"].to_numpy()
        v = unit(_stack(rows["vec"], kind))
        flat, sizes = rows["nbrs"].combine_chunks().flatten().to_numpy(), np.diff(rows["nbrs"].combine_chunks().offsets.to_numpy())
        at = np.searchsorted(ids, flat)
        at[at == len(ids)] = 0
        here = ids[at] == flat  # of the united lists, what lies in this shard
        owner, targets = np.repeat(np.arange(len(ids)), sizes)[here], at[here]
        starts = np.searchsorted(owner, np.arange(len(ids) + 1))
        home = np.flatnonzero(rows["homeleaf"].to_numpy() == rows["leaf"].to_numpy())
        links = Links(rows, v, least)
        step = max(1, PAIRS // len(ids))
        for lo in range(0, len(home), step):
            q, y = search(v, starts, targets, home[lo : lo + step], least, effort)
            x = home[lo : lo + step][q]
            links.add(x[x != y], y[x != y])
        return links.table()

    return work


def _search_tile(least: float, kind: str):
    """Links between two blocks of a shard that is too large for a graph in one task: every pair."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows["cid"].to_numpy(), kind="stable")))
        v = unit(_stack(rows["vec"], kind))
        single = v.astype(np.float32)
        block, here = rows["block"].to_numpy(), rows["homeleaf"].to_numpy() == rows["leaf"].to_numpy()
        left = np.flatnonzero((block == rows["i"][0].as_py()) & here)
        right = np.flatnonzero(block == rows["j"][0].as_py())
        links = Links(rows, v, least)
        step = max(1, PAIRS // max(1, len(right)))
        for lo in range(0, len(left), step):
            x, y = linked(v, single, left[lo : lo + step], right, least)
            links.add(x[x != y], y[x != y])
        return links.table()

    return work


def graph_links(classes: DataFrame, least: float, kind: str, effort: int = EFFORT, wide: bool = False) -> DataFrame:
    """The links of the classes, as _found has them, by the graph."""
    dealt = cut(shards(classes, least, kind, wide))
    where = dealt.groupBy("cid").agg(F.max(F.when(F.col("home"), F.col("leaf"))).alias("homeleaf"), F.collect_list("leaf").alias("leaves"))
    sizes = _few(dealt.groupBy("leaf").agg(F.count("*").alias("rows")))
    members = classes.join(where, "cid").withColumn("leaf", F.explode("leaves")).join(sizes, "leaf")
    members = cut(members.select("leaf", "cid", "vec", "mult", "homeleaf", "leaves", "rows"))
    small, large = members.where(F.col("rows") <= 2 * SPLIT), members.where(F.col("rows") > 2 * SPLIT)
    built = small.select("leaf", "cid", "vec").groupBy("leaf").applyInArrow(grouped(_build(kind)), "cid long, nbrs array<long>")
    united = built.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"))
    found = small.join(united, "cid").groupBy("leaf").applyInArrow(grouped(_search_shard(least, effort, kind)), "a long, b long, n long")
    blocks = F.ceil(F.col("rows") / TILE).cast("int")
    tiles = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cid", F.lit("block")), "blocks").cast("int"))
    # a block of vectors at home meets every block
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    ends = F.concat(F.transform(other, lambda o: F.struct(F.col("block").alias("i"), o.alias("j"))), F.transform(F.filter(other, lambda o: o != F.col("block")), lambda o: F.struct(o.alias("i"), F.col("block").alias("j"))))
    tiles = tiles.withColumn("e", F.explode(ends)).select("leaf", "cid", "vec", "mult", "homeleaf", "leaves", "block", "e.i", "e.j")
    return cut(found.unionByName(tiles.groupBy("leaf", "i", "j").applyInArrow(grouped(_search_tile(least, kind)), "a long, b long, n long")))


def _brute(queries: list[tuple[int, bytes]], least: float, kind: str):
    known = [(c, np.frombuffer(x, kind).astype(np.float64)) for c, x in queries]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: dict[int, int] = {}
        rows = [np.frombuffer(x.as_buffer(), kind).astype(np.float64) for x in batch.column(1)]
        ids, mult = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        for size in {len(r) for r in rows}:
            at = np.array([i for i, r in enumerate(rows) if len(r) == size])
            own = [(c, r) for c, r in known if len(r) == size]
            if own:
                sims = unit(np.stack([x for _, x in own])) @ unit(np.stack([rows[i] for i in at])).T
                hit = (sims >= least) & (np.array([c for c, _ in own])[:, None] != ids[at][None])
                for (c, _), n in zip(own, (hit * mult[at]).sum(1), strict=True):
                    total[c] = total.get(c, 0) + int(n)
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["cid", "n"])

    return work


def audit(classes: DataFrame, counts: DataFrame, least: float, kind: str, sample: int = AUDIT) -> float | None:
    """Mean share of its links that a vector was found to have, by brute force against all vectors: for ``sample``
    classes of those with links and ``sample`` of all, each by smallest hash. None if none of them has a link."""

    def some(rows: DataFrame, seed: str) -> list:
        return rows.withColumn("h", F.xxhash64("cid", F.lit(seed))).orderBy("h").limit(sample).select("cid", "vec").collect()

    chosen = {r.cid: bytes(r.vec) for r in some(classes, "all") + some(classes.join(counts.select("cid"), "cid", "left_semi"), "linked")}
    if not chosen:
        return None
    truth = map_arrow(classes, "cid long, n long", _brute(list(chosen.items()), least, kind)).groupBy("cid").agg(F.sum("n").alias("n")).where("n > 0").collect()
    found = {r.cid: r.n for r in counts.where(F.col("cid").isin(list(chosen))).collect()}
    return float(np.mean([min(1.0, found.get(r.cid, 0) / r.n) for r in truth])) if truth else None


def block_rows(rows: int, width: int) -> int:
    """Rows of a block for so many vectors of ``width`` bytes."""
    return max(1, min(max(BLOCK_LEAST, min(BLOCK, -(-rows // BLOCKS))), BLOCK_BYTES // max(1, width)))


def pack(cells: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, list[int]]:
    """(block of each cell, parts of each block): near cells together up to ``most`` rows; a larger one is parted."""
    block, parts = np.full(len(cells), -1), []
    for first in range(len(cells)):
        if block[first] < 0:
            block[first] = len(parts)
            room = most - sizes[first]
            for c in np.argsort(-(cells @ cells[first]), kind="stable"):
                if block[c] < 0 and sizes[c] <= room:
                    block[c] = len(parts)
                    room -= sizes[c]
            parts.append(max(1, -(-int(sizes[first]) // most)))
    return block, parts


def _rows(column: pa.Array, kind: str, dim: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Vectors as float64, and which of them have the length of the centroids."""
    rows = [np.frombuffer(x.as_buffer(), kind).astype(np.float64) for x in column]
    return rows, np.array([len(r) == dim for r in rows], bool)


def _sizes(cells: np.ndarray, kind: str):
    """Rows of each cell; those of other lengths aren't counted."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, inside = _rows(batch.column(0), kind, cells.shape[1])
        own = (unit(np.stack([r for r, ok in zip(rows, inside, strict=True) if ok])) @ cells.T).argmax(1) if inside.any() else np.zeros(0, np.int64)
        cell, n = np.unique(own, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    return work


def _place(cells: np.ndarray, block: np.ndarray, parts: list[int], others: dict[int, int], limit: float, kind: str):
    """Cell, block and all blocks within reach of each class; ``others`` has the blocks of other lengths."""
    gaps = np.linalg.norm(cells[:, None] - cells[None], axis=2)
    first = np.concatenate(([0], np.cumsum(parts)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, inside = _rows(batch.column(1), kind, cells.shape[1])
        ids = batch.column(0).to_numpy()
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        cell = np.full(len(rows), -1)
        group = np.array([-1 if ok else others[len(r)] for r, ok in zip(rows, inside, strict=True)])
        reach: list[set[int]] = [{g} for g in group.tolist()]
        if inside.any():
            sims = unit(np.stack([r for r, ok in zip(rows, inside, strict=True) if ok])) @ cells.T
            at = np.arange(len(sims))
            best = sims.argmax(1)
            gap = np.where(gaps[best] > 0, gaps[best], np.inf)
            # distance to the plane between the own cell and each other one
            near = (sims[at, best][:, None] - sims) / gap <= limit
            cell[inside], group[inside] = best, block[best]
            for i, row in zip(np.flatnonzero(inside), near, strict=True):
                reach[i] = set(block[row].tolist()) | {int(group[i])}
        own = first[group] + (mixed % np.array(parts, np.uint64)[group]).astype(np.int64)
        met = [[x for g in sorted(r) for x in range(first[g], first[g + 1])] for r in reach]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(cell, pa.int32()), pa.array(own, pa.int32()), pa.array(met, pa.list_(pa.int32()))], ["cid", "vec", "mult", "cell", "block", "met"])

    return work


def linked(v: np.ndarray, single: np.ndarray, x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows x and rows y of the unit vectors v whose cosine is at least ``least`` in double precision."""
    sims = single[x] @ single[y].T
    slack = (v.shape[1] + 8) * 1.2e-7  # more than the error of single precision
    a, b = np.nonzero(sims >= least - slack)
    fine = sims[a, b] >= least + slack
    a, b = x[a], y[b]
    doubt = np.flatnonzero(~fine)
    for lo in range(0, len(doubt), 50_000):
        d = doubt[lo : lo + 50_000]
        fine[d] = np.einsum("ij,ij->i", v[a[d]], v[b[d]]) >= least
    return a[fine], b[fine]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links (a[i], b[i]) that connect what isn't yet; equal labels are connected."""
    out: list[tuple[int, int]] = []
    new = label[a] != label[b]
    a, b = a[new], b[new]
    if not len(a):
        return out
    edges = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    for lo, hi in zip(edges, [*edges[1:], len(a)], strict=True):
        groups, first = np.unique(label[b[lo:hi]], return_index=True)
        mine = label[a[lo]]
        out += [(int(a[lo]), int(b[lo + f])) for g, f in zip(groups, first, strict=True) if g != mine]
        label[np.isin(label, groups)] = mine
    return out


def _tile(cells: np.ndarray, least: float, limit: float, kind: str):
    """All links between two blocks, or within one: n for both ends, and edges that connect the linked classes."""

    def work(rows: pa.Table) -> pa.Table:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        cell, block, ids, mult = (rows[c].to_numpy() for c in ("cell", "block", "cid", "mult"))
        order = np.lexsort((ids, cell, block))
        cell, block, ids, mult = cell[order], block[order], ids[order], mult[order]
        v = unit(_stack(rows["vec"].take(pa.array(order)), kind))
        single = v.astype(np.float32)
        runs = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]))))
        runs = [np.arange(lo, hi) for lo, hi in zip(runs, [*runs[1:], len(ids)], strict=True)]
        total, label, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
        for i, one in enumerate(runs):
            for two in runs[i:]:
                if low != high and block[one[0]] == block[two[0]]:
                    continue  # done with the block's own task
                far, gap = None, np.linalg.norm(cells[cell[one[0]]] - cells[cell[two[0]]]) if cell[one[0]] >= 0 else 0
                x, y = one, two
                if gap > 0:
                    axis = (cells[cell[one[0]]] - cells[cell[two[0]]]) / gap
                    near, far = v[one] @ axis, -(v[two] @ axis)
                    x, near = one[near.argsort(kind="stable")], np.sort(near)
                step = max(1, (1 << 20) // len(two))
                for lo in range(0, len(x), step):
                    some = x[lo : lo + step]
                    if far is not None:
                        y = two[far <= limit - near[lo]]
                        if not len(y):
                            break
                    elif one is two:
                        y = two[lo + 1 :]  # the pairs before were the others' turn
                    a, b = linked(v, single, some, y, least)
                    if one is two:
                        a, b = a[a < b], b[a < b]
                    if len(a):
                        np.add.at(total, a, mult[b])
                        np.add.at(total, b, mult[a])
                        edges += _join(label, a, b)
        return _found(ids, total, edges)

    return work


def vector_classes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame, str]:
    """(rows with their class id, classes, type of the bytes): equal vectors are one class, named by its smallest id.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, have no class.
    """
    big = float(np.finfo(np.float64).max)
    v = F.col("v")
    kind = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    fine = F.coalesce(F.col("id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= big)) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", fine).withColumn("h1", F.when(fine, F.xxhash64(v))).withColumn("h2", F.when(fine, F.xxhash64(F.lit(1), v)))
    usable = rows.where("ok").select("id", "h1", "h2").distinct()
    groups = usable.groupBy("h1", "h2").agg(F.min("id").alias("cid"), F.count("*").alias("mult"))
    member = cut(rows.select("id", "h1", "h2").join(groups, ["h1", "h2"], "left").select("id", "cid", "mult"))
    classes = rows.where("ok").join(groups, ["h1", "h2"]).where("id = cid").dropDuplicates(["cid"]).select("cid", "v", "mult")

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = pa.array([np.asarray(x, kind).tobytes() for x in batch.column(1).to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), packed, batch.column(2)], ["cid", "vec", "mult"])

    return member, cut(map_arrow(classes, "cid long, vec binary, mult long", pack)), kind


def exhaustive_links(classes: DataFrame, least: float, kind: str) -> DataFrame:
    """The links of the classes, as _found has them, by testing every pair that the link radius allows: a vector meets
    the blocks with a cell whose plane is within the radius."""
    width = np.dtype(kind).itemsize
    lengths = {r["size"]: r["count"] for r in classes.groupBy(F.octet_length("vec").alias("size")).count().collect()}
    common = max(lengths, key=lambda x: (lengths[x], -x), default=0)
    cells = np.zeros((1, 0))
    if common:
        sample = classes.where(F.octet_length("vec") == common).select("vec", F.xxhash64("cid").alias("h")).orderBy("h").limit(FIT_ROWS).collect()
        cells = centroids(unit(np.stack([np.frombuffer(r.vec, kind).astype(np.float64) for r in sample])), min(4 * CELLS, -(-lengths[common] // SHARD)))
    sizes = np.zeros(len(cells), np.int64)
    for r in map_arrow(classes.select("vec"), "cell long, n long", _sizes(cells, kind)).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sizes[r.cell] = r.n
    block, parts = pack(cells, sizes, block_rows(lengths.get(common, 0), common))
    others = {size // width: len(parts) + i for i, size in enumerate(sorted(lengths.keys() - {common}))}
    parts += [-(-lengths[size] // block_rows(lengths[size], size)) for size in sorted(lengths.keys() - {common})]
    limit = link_radius(least)
    placed = map_arrow(classes, "cid long, vec binary, mult long, cell int, block int, met array<int>", _place(cells, block, parts, others, limit, kind))
    dealt = placed.select("cid", "vec", "mult", "cell", "block", F.explode("met").alias("other")).select(F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cid", "vec", "mult", "cell", "block")
    return cut(dealt.groupBy("low", "high").applyInArrow(grouped(_tile(cells, least, limit, kind)), "a long, b long, n long"))


def near_vectors(vectors: DataFrame, least: float = 0.95, floor: float = 0.97, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept, recall) for each row: links are pairs of cosine >= least in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of
    different length don't link. Equal vectors are searched for once and count as often as they occur; a row
    repeated whole counts once. A row with a null id links with nothing, has a null component and is kept. An empty
    table has no rows. Other columns are ignored. recall is what the audit measured, the same in all rows, and null if
    no vector of the audit has a link; below ``floor`` the search is widened and at last exhaustive, where it is 1.
    """
    member, classes, kind = vector_classes(vectors, id_col, vec_col)
    for wide in (False, True):
        links = graph_links(classes, least, kind, EFFORT * (1 + 3 * wide), wide)
        counts = links.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
        recall = audit(classes, counts, least, kind)
        if recall is None or recall >= floor:
            break
    else:
        links, recall = exhaustive_links(classes, least, kind), 1.0
        counts = links.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    reach = connected_components(links.where("b is not null").select("a", "b")).withColumnRenamed("id", "cid")
    out = member.join(counts, "cid", "left").join(reach, "cid", "left")
    component = F.coalesce("component", "cid", "id")
    return out.select(F.col("id").alias(id_col), F.when(F.col("cid").isNull(), F.lit(0)).otherwise(F.coalesce("n", F.lit(0)) + F.col("mult") - 1).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), F.lit(recall).cast("double").alias("recall"))


#: All pairs, for tables small enough for that; the audit then covers every vector.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT x AS id, x AS m FROM p UNION SELECT r.id, p.y FROM r JOIN p ON r.m = p.x
), c AS (SELECT id, min(m) AS component FROM r GROUP BY id), n AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       coalesce(component, vec_id) IS NOT DISTINCT FROM vec_id AS kept, CASE WHEN max(n.n) OVER () > 0 THEN 1.0::DOUBLE END AS recall
FROM embeddings LEFT JOIN n ON vec_id = x LEFT JOIN c ON vec_id = id
"""
