"""Shared helpers: reading tables, cutting lineage, grouped Arrow work, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.storage import cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of an Arrow batch at most: texts are long, and a batch is in memory several times over.
BATCH_ROWS = 1000


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:  # noqa: ANN001
    """mapInArrow in batches of at most BATCH_ROWS rows; the session's setting is lowered to that."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on after its task, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not with glibc
        pass


def grouped(work: Callable) -> Callable:
    """A function for applyInArrow that gives memory back after a group of some size."""

    def by_rows(rows: pa.Table) -> pa.Table:
        out = work(rows)
        if rows.nbytes > 4 << 20:
            give_back()
        return out

    return by_rows


def map_arrow(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None]) -> DataFrame:
    """mapInArrow for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                elif out is not None:
                    yield from out

    return in_arrow(df, run, schema)


class Forest:
    """Union-find over integers; the root of a set is its smallest member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root:
            up[x] = root
            x = p
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True

    def edges(self) -> tuple[list[int], list[int]]:
        """Each member that isn't a root with its root."""
        return list(self.up), [self.find(x) for x in self.up]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), strict=True):
            forest.join(int(a), int(b))
    v, u = forest.edges()
    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(u, pa.int64())], ["v", "u"])


def _stars(edges: DataFrame) -> bool:
    """Has each vertex either one edge, to a smaller one, or only edges to it?"""
    roles = edges.select(F.col("v").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(edges.select(F.col("u").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    each = roles.groupBy("x").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return not each.agg(F.max((F.col("up") + F.col("root") > 1).cast("int"))).first()[0]


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): every end of an edge (two bigint columns) with the smallest id it can reach.

    Alternating large-star and small-star steps over the edge table, after each partition has replaced its own edges
    by a spanning forest, until all edges lead to the smallest id of their component. A step is a partially aggregated
    minimum for each vertex and a join, so a vertex with very many edges is split like any skewed join key; nothing is
    collected. Lineage is cut after every round. An edge from an id to itself names the id only. Null ends are dropped.
    """
    a, b = edges.columns[:2]
    ends = edges.select(F.col(a).cast("long").alias("v"), F.col(b).cast("long").alias("u")).where("v is not null and u is not null")
    now = cut(in_arrow(ends, _contract, "v long, u long").where("v <> u").distinct())
    for _ in range(rounds):
        if _stars(now):
            return now.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(now.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(own_shuffle(least, "v"), "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(own_shuffle(least, "v"), "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.*").where("v <> u").distinct()
        now = cut(small)
    raise RuntimeError("components did not settle")


def own_shuffle(df: DataFrame, key: str) -> DataFrame:
    """The rows of an aggregate by ``key`` (bigint), dealt out anew where they are joined on it.

    An aggregate is already dealt out by its key, and a join on that key would reuse this; then Spark can't split a key
    that very many rows of the other side have. A key that is worked out anew makes the join shuffle both sides itself.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def arrays_to_binary(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """A binary array whose i-th element holds the bytes of values[begin[i]:begin[i+1]]."""
    return pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer((np.asarray(begin, np.int64) * values.itemsize).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())
