"""Mixing sources to target weights (operator 8).

Every document gets a hash-random key. Keys are uniform, so their leading digits cut each source into ranges of even
size, whichever source is large; prefix sums over a source's ranges tell in which of them its budget ends, and a prefix
sum within that range at which document. The budget is cut exactly there, after as many whole epochs as fit: documents
before the cut are in the last epoch, those after it are not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnwright.storage import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
#: Sources up to which their table of cuts (a row each) goes to all executors.
BROADCAST = 100_000


def _source(c: str) -> Column:
    """The source as a key that is never null and keeps code-point order, null last."""
    return F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("f"), F.col(c).cast("string")))


def budgets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(src, source_size, target, budget) from rows (src, total) of the sources' sizes.

    All sizes together are shared by weight; a source takes at most ``most`` times its size and what it can't take is
    shared by weight among the others. That is a water level: with sources in ascending order of most * size / weight,
    the level is what is left over the weights left, at the first source whose own bound it doesn't exceed. Sources are
    ranked in one task, a narrow row each.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.orderBy("src")) - 1) % len(weights) + 1).cast("int"))
    rows = sized.withColumn("w", w).withColumn("bound", F.lit(most) * F.col("total"))
    order = Window.orderBy(F.col("bound") / F.col("w"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("rank", F.row_number().over(order))
    rows = rows.withColumn("left", F.sum("total").over(Window.partitionBy()) - F.coalesce(F.sum("bound").over(before), F.lit(0)))
    rows = rows.withColumn("open", F.sum("w").over(Window.partitionBy()) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    rows = rows.withColumn("level", F.col("left").cast("double") / F.col("open"))
    level = F.min_by("level", F.when(F.col("level") * F.col("w") <= F.col("bound"), F.col("rank"))).over(Window.partitionBy())
    rows = rows.withColumn("level", level)
    target = F.least(F.col("bound").cast("double"), F.col("level") * F.col("w"))
    return rows.select("src", F.col("total").alias("source_size"), target.alias("target"), F.least(F.floor(target + 0.5), F.col("bound")).cast("long").alias("budget"))


def _key(seed: str, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def _size(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def range_digits(rows: int) -> int:
    """Leading hex digits of a key that name its range: about as many ranges as there are rows in each."""
    return max(1, min(8, math.ceil(math.log(max(rows, 1), 16) / 2)))


def cuts(narrow: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, int]:
    """((src, source_size, target, epochs, rest, cut_range, cut_offset), digits) from rows (src, key, size).

    A source's budget holds ``epochs`` times all of it and ``rest`` words more, which end in the range ``cut_range``,
    before which its documents have ``cut_offset`` words.
    """
    digits = range_digits(narrow.count())
    ranges = narrow.groupBy("src", F.substring("key", 1, digits).alias("range")).agg(F.sum("size").alias("total"))
    ranges = cut(ranges)
    shares = budgets(ranges.groupBy("src").agg(F.sum("total").alias("total")), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long")
    shares = shares.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")).drop("budget")
    upto = ranges.withColumn("upto", F.sum("total").over(Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)))
    ends = upto.join(shares.select("src", "rest"), "src").where(F.col("upto") > F.col("rest")).groupBy("src").agg(F.min(F.struct("range", (F.col("upto") - F.col("total")).alias("offset"))).alias("c"))
    found = shares.join(ends, "src", "left").select("src", "source_size", "target", "epochs", "rest", F.coalesce("c.range", F.lit("")).alias("cut_range"), F.coalesce("c.offset", F.lit(0)).alias("cut_offset"))
    found = cut(found)
    return F.broadcast(found) if found.count() <= BROADCAST else found, digits


def _last_epoch(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows outside the ranges that hold a cut, rows inside) with ``last``: the words that the last epoch takes.

    Rows have range and the columns of cuts; those inside have key, size and tie as well. Rows that are equal in these
    are ordered as Spark meets them, which changes no row's values but those of its equals.
    """
    outside = rows.where(F.col("range") != F.col("cut_range"))
    inside = rows.where(F.col("range") == F.col("cut_range"))
    before = F.sum("size").over(Window.partitionBy("src").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1))
    place = F.col("cut_offset") + F.coalesce(before, F.lit(0))
    return outside, inside.withColumn("last", F.greatest(F.lit(0).cast("long"), F.least("size", F.col("rest") - place)))


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, taken) for each row of docs.

    size counts the words of the whole text (null: 0). taken is the words that the mix takes of the document, repeats
    counted: its size for each whole epoch of its source, and in the last epoch what the budget leaves at its place.
    Sources are in code-point order, null last, with weights repeating. A source without words has target 0. Rows of
    equal key (equal or null ids) are ordered by size and a hash of the text, so reruns agree whatever the partitions.
    An empty table has no rows. Other columns are ignored, whatever their names. Texts are read once, and only narrow
    rows are kept.
    """
    narrow = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _source(source_col).alias("src"), _key(seed, id_col).alias("key"), _size(text_col).alias("size"), F.xxhash64(text_col).alias("tie")))
    table, digits = cuts(narrow, weights, most)
    outside, inside = _last_epoch(narrow.withColumn("range", F.substring("key", 1, digits)).join(table, "src"))
    outside = outside.withColumn("last", F.when(F.col("range") < F.col("cut_range"), F.col("size")).otherwise(F.lit(0).cast("long")))
    rows = outside.unionByName(inside)
    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("last")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: docs' columns, a row for each copy taken; a copy cut by the budget ends after its last word
    taken (n_chars, where there is such a column, follows). Documents without words are not taken, nor null texts.

    Documents stay where they lie; only those of the one range of each source that holds its cut are shuffled.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    table, digits = cuts(cut(docs.select(_source(source_col).alias("src"), _key(seed, id_col).alias("key"), _size(text_col).alias("size"))), weights, most)
    text = F.col(f"doc.`{text_col}`")
    rows = docs.where(F.col(text_col).rlike(WORD)).select(whole.alias("doc"), _source(source_col).alias("src"), _key(seed, id_col).alias("key"))
    outside, inside = _last_epoch(rows.withColumn("range", F.substring("key", 1, digits)).withColumn("size", _size(f"doc.`{text_col}`")).withColumn("tie", F.xxhash64(text)).join(table, "src"))
    copies = F.col("epochs") + (F.col("range") < F.col("cut_range")).cast("int")
    outside = outside.where(copies > 0).select("doc", F.explode(F.array_repeat(F.lit(None).cast("long"), copies.cast("int"))).alias("words"))
    copies = F.col("epochs") + (F.col("last") == F.col("size")).cast("int")
    each = F.concat(F.array_repeat(F.lit(None).cast("long"), copies.cast("int")), F.when((F.col("last") > 0) & (F.col("last") < F.col("size")), F.array("last")).otherwise(F.expr("cast(array() as array<bigint>)")))
    taken = outside.unionByName(inside.select("doc", F.explode(each).alias("words")))
    cut_text = F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), F.col("words").cast("int")), "")
    out = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {text_col: F.when(F.col("words").isNull(), text).otherwise(cut_text)}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("words").isNull(), F.col("doc.n_chars")).otherwise(F.length(cut_text).cast("long"))
    return taken.select(*(v.alias(k) for k, v in out.items()))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT), 0) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key, text
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w, 3 * total AS bound FROM s
), r AS (
  SELECT *, row_number() OVER o AS rank,
         CAST(sum(total) OVER () AS BIGINT) - CAST(coalesce(sum(bound) OVER b, 0) AS BIGINT) AS rest,
         CAST(sum(w) OVER () AS BIGINT) - CAST(coalesce(sum(w) OVER b, 0) AS BIGINT) AS open
  FROM w
  WINDOW o AS (ORDER BY bound / w, source NULLS LAST),
         b AS (ORDER BY bound / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (SELECT *, CAST(rest AS DOUBLE) / open AS lv FROM r),
lv AS (SELECT arg_min(lv, rank) AS level FROM l WHERE lv * w <= bound),
t AS (
  SELECT source, total, bound, least(CAST(bound AS DOUBLE), level * w) AS target,
         least(CAST(floor(least(CAST(bound AS DOUBLE), level * w) + 0.5) AS BIGINT), bound) AS budget
  FROM l, lv
), p AS (
  SELECT d.*, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM d
)
SELECT p.doc_id, p.size, t.total AS source_size, t.target,
       CASE WHEN t.total > 0 THEN (t.budget // t.total) * p.size
            + greatest(0, least(p.size, t.budget - (t.budget // t.total) * t.total - p.place)) ELSE 0 END AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""
