"""Small array expressions that stay linear on very long arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once per row.

    A column used inside a lambda is otherwise evaluated anew for every
    element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def sums_before(lengths: Column) -> Column:
    """For each number of an array<long>, the sum of those before it.

    Sums inside blocks first, then over the blocks, so the work is n * BLOCK
    and not n * n.
    """
    zero, none = F.lit(0).cast("long"), F.slice(F.array(F.lit(0).cast("long")), 1, 0)

    def block(a: Column, b: Column) -> Column:
        return F.aggregate(
            F.slice(a, (b * BLOCK + 1).cast("int"), F.lit(BLOCK)), F.struct(zero.alias("sum"), none.alias("at")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["at"], F.array(acc["sum"])).alias("at")))

    def joined(blocks: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda one, i: let(
            F.aggregate(F.slice(blocks, F.lit(1), i), zero, lambda acc, x: acc + x["sum"]),
            lambda base: F.transform(one["at"], lambda x: x + base))))

    return F.when(F.size(lengths) > 0, let(lengths, lambda a: let(
        F.transform(F.sequence(F.lit(0), ((F.size(a) - 1) / BLOCK).cast("int")), lambda b: block(a, b)), joined))
    ).otherwise(none)
