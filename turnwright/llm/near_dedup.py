"""Near-duplicate documents by HyperMinHash (operator 5).

Each distinct shingle set is sketched in 256 registers: a shingle's hash picks a register, which keeps, of the
smallest remaining hash, the number of leading zeros and the ten bits after the leading one. Registers compressed to
16 bits are banded, from a threshold of 0.85 on in 32 bands of 8, below that in 42 bands of 6: a pair at 0.85 or 0.8
is missed by every band with probability 4e-5 or 3e-6. Candidates pass the collision-corrected Jaccard estimate with a
margin of five standard deviations, and are then verified on their full sets.

Not every pair of a bucket is tried. Texts with equal sets are one class. Every class is first compared with its
bucket's pivot, the member that shares most buckets; the links found give components. Only buckets whose members then
lie in several components are worked through: blocks of at most BLOCK members are compared pair by pair on their
registers, and what passes the estimate across components is verified on full sets within the task. Tasks return
spanning forests, never all pairs, and no pair between components goes untested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnwright.llm import shingles as S
from turnwright.llm.common import Forest, arrays_to_binary, connected_components, grouped, map_arrow, own_shuffle
from turnwright.storage import cut

REGISTERS = 256
MANTISSA = 10
#: Registers of a band, widest first, and the chance at most that a pair at the threshold shares no bucket.
WIDTHS, MISS = (8, 6, 5, 4, 3, 2, 1), 4e-5
BLOCK, BLOCK_VALUES = 1024, 4_000_000
_rng = np.random.Generator(np.random.PCG64(7))
DONORS = _rng.integers(0, REGISTERS, (8, REGISTERS))
BAND_HASH = _rng.integers(1, 1 << 62, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (texts x 256, uint16) of sets of 64-bit hashes; 0 is an empty register."""
    n = len(begin) - 1
    least = np.full(n * REGISTERS, np.uint64(2**64 - 1))
    at = np.repeat(np.arange(n) * REGISTERS, np.diff(begin)) + (values & np.uint64(REGISTERS - 1)).astype(np.int64)
    np.minimum.at(least, at, values >> np.uint64(8))
    x = least >> np.uint64(3)
    length = np.frexp(x.astype(np.float64))[1]
    zeros = np.clip(53 - length, 0, 53)
    part = ((x << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = (zeros.astype(np.uint64) << np.uint64(MANTISSA)) + part + np.uint64(1)
    out[least == np.uint64(2**64 - 1)] = 0
    return out.astype(np.uint16).reshape(n, REGISTERS)


def band_width(percent: int) -> int:
    """Registers of a band: as many as keep the chance that a pair at the threshold shares no bucket at MISS or less."""
    for width in WIDTHS:
        if (1 - (percent / 100) ** width) ** (REGISTERS // width) <= MISS:
            return width
    raise ValueError(f"a threshold of {percent} percent is too low for {REGISTERS} registers")


def band_keys(regs: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit key for each band (texts x bands). Empty registers borrow from others, chosen alike for every text."""
    filled = regs.copy()
    for donor in DONORS:
        empty = filled == 0
        if not empty.any():
            break
        filled = np.where(empty, regs[:, donor], filled)
    for i in np.flatnonzero((filled == 0).any(1) & (regs != 0).any(1)):
        have = np.flatnonzero(filled[i])
        filled[i] = filled[i][have[np.searchsorted(have, np.arange(REGISTERS)) % len(have)]]
    bands = REGISTERS // width
    used = (filled.astype(np.uint64) * BAND_HASH)[:, : bands * width]
    return S.mix(used.reshape(len(regs), bands, width).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def _collision_table() -> tuple[np.ndarray, np.ndarray]:
    """Expected share of registers that agree by chance, for two disjoint sets of 2**i and 2**j shingles."""
    sizes = 2.0 ** np.arange(0, 25, 2)
    cells = []
    for zeros in range(54):
        step = 2.0 ** -(zeros + 1 + MANTISSA)
        low = 2.0 ** -(zeros + 1) + step * np.arange(1 << MANTISSA)
        cells.append((low, low + step))
    low, high = (np.concatenate(x) for x in zip(*cells, strict=True))
    share = [np.exp(n * np.log1p(-low / REGISTERS)) - np.exp(n * np.log1p(-np.minimum(high / REGISTERS, 1))) for n in sizes]
    return np.log2(sizes), np.array([[float(a @ b) for b in share] for a in share])


_collisions: tuple[np.ndarray, np.ndarray] | None = None


def jaccard_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard of sketches row by row (HyperMinHash: agreeing registers less the expected chance
    agreements, over registers in use)."""
    global _collisions
    if _collisions is None:
        _collisions = _collision_table()
    logs, share = _collisions
    used = ((a != 0) | (b != 0)).sum(-1)
    same = ((a == b) & (a != 0)).sum(-1)
    i = np.clip(np.rint(np.log2(np.maximum(n_a, 1)) / 2).astype(int), 0, len(logs) - 1)
    j = np.clip(np.rint(np.log2(np.maximum(n_b, 1)) / 2).astype(int), 0, len(logs) - 1)
    chance = share[i, j] * REGISTERS
    return np.clip((same - chance) / np.maximum(used - chance, 1), 0, 1)


def margin(threshold: float) -> float:
    return threshold - 5 * math.sqrt(threshold * (1 - threshold) / REGISTERS)


def _summed(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return pa.array((total[begin[1:]] - total[begin[:-1]]).view(np.int64))


def _sketch(k: int, width: int):
    """Size, two sums of hashes that name the set, and band keys of each text, from rows (id, th, text)."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, data, offsets in S.text_chunks(batch.column(2)):
            hashes, _, begins = S.words(data, offsets)
            values, begin = S.distinct(*S.shingles(hashes, begins, k))
            ids, th = (batch.column(i).slice(first, len(begin) - 1) for i in (0, 1))
            keys = band_keys(registers(values, begin), width)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids, th, pa.array(np.diff(begin), pa.int64()), _summed(values, begin), _summed(S.mix(values ^ S.BASE), begin), keys], ["id", "th", "n", "h1", "h2", "bands"])

    return work


def _full_sets(k: int):
    """Size, registers and full set of each text, from rows (cid, text)."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, data, offsets in S.text_chunks(batch.column(1)):
            hashes, _, begins = S.words(data, offsets)
            values, begin = S.distinct(*S.shingles(hashes, begins, k))
            regs = registers(values, begin).reshape(-1)
            cids = batch.column(0).slice(first, len(begin) - 1)
            yield pa.RecordBatch.from_arrays([cids, pa.array(np.diff(begin), pa.int64()), arrays_to_binary(regs, np.arange(len(begin)) * REGISTERS), arrays_to_binary(values, begin)], ["id", "n", "regs", "set"])

    return work


def _is_link(inter: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * inter >= percent * (n_a + n_b - inter)


def _intersection(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _estimate_pairs(percent: int):
    """The pairs that pass the estimate, from rows (a, b, n_a, n_b, regs_a, regs_b)."""
    least = margin(percent / 100)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
        regs = [np.array([np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(i)]) for i in (4, 5)]
        maybe = jaccard_estimate(*regs, n_a, n_b) >= least
        maybe &= 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
        return batch.select(["a", "b"]).filter(pa.array(maybe))

    return work


def _verify_pairs(percent: int):
    """The pairs that are links, from rows (a, b, set_a, set_b)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(i)] for i in (2, 3)]
        linked = [_is_link(_intersection(x, y), len(x), len(y), percent) for x, y in zip(*sets, strict=True)]
        return batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return work


def _cross_pairs(rows: pa.Table, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows (block i with block j of a bucket) that lie in different components and pass the estimate.

    A pair that shares an earlier band as well is left to that band's bucket.
    """
    least = margin(percent / 100)
    block, n, comp, band = (rows[c].to_numpy() for c in ("block", "n", "comp", "band"))
    regs = np.array([np.frombuffer(x.as_buffer(), np.uint16) for x in rows["regs"]])
    keys = band_keys(regs, band_width(percent))[:, : int(band[0])]
    i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
    left = np.flatnonzero(block == i)
    right = np.flatnonzero(block == j)
    for x in left:
        y = right[right > x] if i == j else right
        y = y[(comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))]
        if len(y):
            y = y[~(keys[y] == keys[x]).any(1)]
        if len(y):
            y = y[jaccard_estimate(regs[y], regs[x], n[y], n[x]) >= least]
        for z in y:
            yield int(x), int(z)


def _flag(percent: int):
    def work(rows: pa.Table) -> pa.Table:
        hit: set[int] = set()
        for x, y in _cross_pairs(rows, percent):
            hit |= {x, y}
        return rows.take(pa.array(sorted(hit), pa.int64())).select(["key", "i", "j", "block", "id", "comp", "band"])

    return work


def _verify_block(percent: int):
    def work(rows: pa.Table) -> pa.Table:
        ids, comp, n = (rows[c].to_numpy() for c in ("id", "comp", "n"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["set"]]
        forest, out = Forest(), []
        for x, y in _cross_pairs(rows, percent):
            if forest.find(int(comp[x])) != forest.find(int(comp[y])) and _is_link(_intersection(sets[x], sets[y]), int(n[x]), int(n[y]), percent):
                forest.join(int(comp[x]), int(comp[y]))
                out.append((int(ids[x]), int(ids[y])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return work


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of docs.

    Documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of distinct shingles of ``words``
    words. A text of fewer words is one shingle; null, empty and blank texts have none and link with nothing. Rows
    with equal ids are one document: whatever one of them links with, all do, and all are returned; which texts they
    have doesn't depend on the order of rows. A row whose id is null has a null component and is kept. An empty table
    has no rows. Other columns are ignored, whatever their names.
    """
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    sketched = cut(map_arrow(base, "id long, th long, n long, h1 long, h2 long, bands array<long>", _sketch(words, band_width(percent))))
    usable = sketched.where("id is not null and n > 0")
    # a class is a set; the row of its smallest id (of several, of the smallest text hash) stands for it
    classes = cut(usable.groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "th")).alias("rep"), F.any_value("bands").alias("bands")))
    classes = classes.select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "n", "rep.id", "rep.th", "bands").toDF("id", "h1", "h2", "n", "rep", "th", "bands")
    bands = classes.select("id", F.posexplode("bands").alias("band", "key"))
    full = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = cut(bands.join(own_shuffle(full, "key"), "key"))
    degree = buckets.groupBy("id").agg(F.sum("size").alias("degree"))
    pivots = buckets.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("id"))).alias("p")).select("key", (-F.col("p.id")).alias("pivot"))
    pairs = buckets.join(own_shuffle(pivots, "key"), "key").where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    wanted = classes.join(buckets.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("cid"), F.col("rep").alias("id"), "th")
    sets = cut(map_arrow(base.join(wanted, ["id", "th"]).select("cid", "text"), "id long, n long, regs binary, set binary", _full_sets(words)).dropDuplicates(["id"]))

    def both(pairs: DataFrame, *columns: str) -> DataFrame:
        for c in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("id").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in columns)), c)
        return pairs.select("a", "b", *(f"{x}_{c}" for x in columns for c in ("a", "b")))

    maybe = cut(map_arrow(both(pairs, "n", "regs"), "a long, b long", _estimate_pairs(percent)))
    links = cut(map_arrow(both(maybe, "set"), "a long, b long", _verify_pairs(percent)))
    groups = connected_components(links)
    more = cut(_residual(buckets, groups, sets, percent).unionByName(_same_ids(usable, classes)))
    if not more.isEmpty():  # on top of what is connected already
        groups = connected_components(groups.toDF("a", "b").unionByName(more))
    linked = groups.join(classes.select("id", "rep"), "id")
    least = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    reach = linked.join(own_shuffle(least, "component"), "component").select("id", "component_id")
    found = cut(classes.select("id", "h1", "h2", "n", "rep").join(reach, "id", "left").select("h1", "h2", "n", F.coalesce("component_id", "rep").alias("component_id")))
    rows = sketched.select("id", F.col("n").alias("n_shingles"), *(F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col(c)).alias(f"{c}_") for c in ("h1", "h2", "n")))
    out = rows.join(found, (rows.h1_ == found.h1) & (rows.h2_ == found.h2) & (rows.n_ == found.n), "left").select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _same_ids(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of an id that has several texts."""
    one = F.xxhash64("h1", "h2", "n")
    several = cut(usable.groupBy("id").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).where("lo <> hi").select("id"))
    if several.isEmpty():
        return several.select(F.col("id").alias("a"), F.col("id").alias("b"))
    rows = usable.select("id", "h1", "h2", "n").join(several, "id", "left_semi").join(classes.select(F.col("id").alias("b"), "h1", "h2", "n"), ["h1", "h2", "n"]).select("id", "b").distinct()
    return rows.join(own_shuffle(rows.groupBy("id").agg(F.min("b").alias("a")), "id"), "id").select("a", "b").where("a <> b")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Of each group of near duplicates the rows of the smallest id, and of rows with equal ids one, with all their
    columns. Rows whose id is null stay, as do documents without words."""
    found = cut(near_duplicates(docs.select(id_col, text_col), id_col, text_col, words, percent).select(F.col(id_col).alias("id"), "kept"))
    gone = found.where("not kept").select("id").distinct()
    left = docs.join(gone, docs[id_col].cast("long") == gone["id"], "left_anti")
    again = cut(found.where("kept and id is not null").groupBy("id").count().where("count > 1").select("id"))
    if again.isEmpty():
        return left
    same = left[id_col].cast("long") == again["id"]
    ranked = left.join(again, same, "left_semi").select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    order = F.row_number().over(Window.partitionBy(f"row.`{id_col}`").orderBy(F.xxhash64(f"row.`{text_col}`"), F.xxhash64("row")))
    return left.join(again, same, "left_anti").unionByName(ranked.withColumn("nth", order).where("nth = 1").select("row.*"))


def _residual(buckets: DataFrame, components: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components within buckets that the pivots left apart."""
    held = buckets.where("size > 2").join(components, "id", "left").select("key", "band", "size", "id", F.coalesce("component", "id").alias("comp"))
    apart = held.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("rows")).where("c0 <> c1").select("key", F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK)).cast("int").alias("blocks"))
    rows = held.join(own_shuffle(apart, "key"), "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o")).drop("o")

    sketches = sets.select("id", "n", "regs")
    members = spread(rows).join(sketches, "id").select("key", "i", "j", "block", "id", "comp", "band", "n", "regs")
    flagged = cut(members.groupBy("key", "i", "j").applyInArrow(grouped(_flag(percent)), "key long, i int, j int, block int, id long, comp long, band int").select("key", "id", "comp", "band").distinct())
    sizes = flagged.join(sets.select("id", "n"), "id").groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_VALUES)).cast("int").alias("blocks"))
    rows = flagged.join(own_shuffle(sizes, "key"), "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = spread(rows).join(sets, "id").select("key", "i", "j", "block", "id", "comp", "band", "n", "regs", "set")
    return members.groupBy("key", "i", "j").applyInArrow(grouped(_verify_block(percent)), "a long, b long")


#: All pairs that share a shingle, for tables small enough for that.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS grams
  FROM w
), u AS (SELECT doc_id, len(grams) AS n, unnest(list_transform(grams, lambda g: hash(g))) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT x AS id, x AS m FROM p UNION SELECT r.id, p.y FROM r JOIN p ON r.m = p.x
), c AS (SELECT id, min(m) AS component FROM r GROUP BY id)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) IS NOT DISTINCT FROM doc_id AS kept
FROM s LEFT JOIN c ON doc_id = id
"""
