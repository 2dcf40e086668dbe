"""Prefix scans over the arrays of a row, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often ``use`` refers to it within lambdas."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def scanned(values: Column, op: Callable[[Column, Column], Column] = lambda a, b: a + b, kind: str = "int") -> Column:
    """Running results of an associative ``op`` over an array: running sums unless told otherwise.

    Appending to an array copies it, so the array is taken in blocks of its length's square root: each block is scanned
    by itself, then what the blocks before it come to is added. An array of a million elements takes some milliseconds
    a thousand, not hours.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def blockwise(x: Column) -> Column:
        n = F.size(x)
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double"))).cast("int"))
        blocks = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), step), lambda i: F.slice(x, i, step))

        def grow(done: Column, v: Column) -> Column:
            return F.concat(done, F.array(F.when(F.size(done) == 0, v).otherwise(op(F.try_element_at(done, F.lit(-1)), v))))

        each = F.transform(blocks, lambda b: F.aggregate(b, none, grow))

        def join(done: Column, block: Column) -> Column:
            before = F.try_element_at(F.try_element_at(done, F.lit(-1)), F.lit(-1))
            moved = F.when(F.size(done) == 0, block).otherwise(bound(before, lambda p: F.transform(block, lambda v: op(p, v))))
            return F.concat(done, F.array(moved))

        return F.flatten(F.aggregate(each, F.expr(f"cast(array() as array<array<{kind}>>)"), join))

    return bound(values, blockwise)
