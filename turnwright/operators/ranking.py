"""Global positions without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of df has it."""
    out = []
    for name in names:
        while name in df.columns:
            name = f"_{name}"
        out.append(name)
    return out


def shuffled_positions(ids: DataFrame, id_col: str, seed: int, name: str = "pos") -> DataFrame:
    """ids with a 0-based position in the order of md5(seed:id), the same for every partitioning.

    The hash is uniform, so its first three digits cut the rows into even ranges; a row's position is its number
    within its range plus the sizes of the ranges before it.
    """
    key, range_, start, n = spare(ids, "_key", "_range", "_start", "_n")
    keyed = ids.withColumn(key, F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))).withColumn(range_, F.substring(key, 1, 3))
    before = Window.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy(range_).agg(F.count("*").alias(n)).select(range_, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(range_).orderBy(key, id_col)
    return keyed.join(starts, range_).withColumn(name, F.col(start) + F.row_number().over(inside) - 1).select(*ids.columns, name)


def split_by_ratio(positions: DataFrame, ratio: float, pos: str = "pos", name: str = "split") -> DataFrame:
    """The first max(1, floor(n * ratio)) positions are ``train``, the rest ``valid``."""
    total = positions.agg(F.count("*").alias("n")).scalar()
    bound = F.greatest(F.lit(1), F.floor(total * F.lit(ratio)))
    return positions.withColumn(name, F.when(F.col(pos) < bound, F.lit("train")).otherwise(F.lit("valid")))


#: Ids that mersenne_positions takes at most: they pass through the driver.
MOST_IDS = 1_000_000


def mersenne_positions(ids: DataFrame, id_col: str, seed: int, order: str | None = None, name: str = "pos") -> DataFrame:
    """Positions as Python's seeded shuffle of the ids in their order gives them, for datasets that must match such a
    run. The list passes through the driver, so more than MOST_IDS ids raise; shuffled_positions has no such bound."""
    import random

    listed = [r[0] for r in ids.orderBy(order or id_col).select(id_col).limit(MOST_IDS + 1).collect()]
    if len(listed) > MOST_IDS:
        raise ValueError(f"more than {MOST_IDS} ids; use shuffled_positions")
    random.Random(seed).shuffle(listed)
    places = ids.sparkSession.createDataFrame([(x, i) for i, x in enumerate(listed)], f"{id_col} {ids.schema[id_col].dataType.simpleString()}, {name} long")
    return ids.join(places, id_col)
