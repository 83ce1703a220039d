"""A set of values as a fixed number of bits, for filters that run before a shuffle.

The bitmap is a scalar subquery: Spark computes it with the query that uses it,
so no job runs while the query is built, and its size does not depend on the
data.  A value of the set is always found; others are found now and then, so
an exact join follows the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmap_of(values: DataFrame, column: str, bits: int) -> Column:
    """The hashes of a column as an array of ``bits / 64`` longs."""
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    words = values.select(place.alias("place")).groupBy(F.expr("CAST(place div 64 AS INT)").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits")
    )
    # The words in order, then the empty ones between them filled in.
    held = words.agg(F.array_sort(F.collect_list(F.struct("w", "bits"))).alias("held"))
    filled = F.aggregate(
        F.col("held"),
        F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).alias("next")),
        lambda a, x: F.struct(
            F.concat(a["out"], F.array_repeat(F.lit(0).cast("long"), x["w"] - a["next"]), F.array(x["bits"])).alias("out"),
            (x["w"] + 1).alias("next"),
        ),
        lambda a: F.concat(a["out"], F.array_repeat(F.lit(0).cast("long"), F.lit(bits // 64) - a["next"])),
    )
    return held.select(filled.alias("bitmap")).scalar()


def maybe_in(bitmap: Column, c: Column, bits: int) -> Column:
    """Whether the bit of a value is set."""
    place = F.pmod(F.xxhash64(c), F.lit(bits))
    word = F.element_at(bitmap, (F.floor(place / 64) + 1).cast("int"))
    return F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
