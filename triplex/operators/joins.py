"""Equi joins of a large relation against a set of keys, with the heavy keys split.

The large side may hold a hot key (one id referenced by a third of all rows).
Its keys are counted first (combined map side, so the count of a hot key costs
one row per task), and only keys of more than ``HEAVY_ROWS`` rows are split:
each into as many pieces as it has times that many rows, by a hash of the whole
row, so a retried task deals every row out as before.  On the key side only
those keys are repeated, once per piece.  All others are joined as they are.

The list of heavy keys holds the ``MAX_HEAVY`` heaviest at most, as 64-bit
hashes, so it can be broadcast at any size of the data.  Which keys it holds
decides about speed only: a key that it misses is joined whole, two keys of one
hash are both split.  Everything is one lazy plan; no job runs while it is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task may get.
HEAVY_ROWS = 1_000_000
#: Heavy keys at most; the next heaviest are joined whole.
MAX_HEAVY = 65_536

_HASH, _PIECES, _PIECE, _KEY = "__hash", "__pieces", "__piece", "__key"


def heavy_keys(big: DataFrame, big_key: str, heavy_rows: int = HEAVY_ROWS, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """``__hash, __pieces`` of the keys with more than ``heavy_rows`` rows, the heaviest ``max_heavy``."""
    counts = (
        big.select(big_key).where(F.col(big_key).isNotNull())
        .groupBy(F.xxhash64(big_key).alias(_HASH)).agg(F.count(F.lit(1)).alias("__n"))
    )
    return heavy_of_counts(counts, heavy_rows, max_heavy)


def heavy_of_counts(counts: DataFrame, heavy_rows: int = HEAVY_ROWS, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """``__hash, __pieces`` from ``counts (__hash, __n)``."""
    return (
        counts.where(F.col("__n") > heavy_rows).orderBy(F.desc("__n"), _HASH).limit(max_heavy)
        .select(_HASH, F.ceil(F.col("__n") / heavy_rows).alias(_PIECES))
    )


def _dealt(big: DataFrame, table: DataFrame, big_key: str, heavy: DataFrame):
    """Both sides with the piece that each row belongs to, and the join condition; ``table`` has a column ``__key``."""
    heavy = F.broadcast(heavy)
    # Rows without a key match nothing; they are spread like a heavy key's rows.
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    piece = F.when(F.col(big_key).isNull(), whole_row).otherwise(
        F.pmod(whole_row, F.coalesce(F.col(_PIECES), F.lit(1).cast("long")))
    )
    left = (
        big.withColumn(_HASH, F.xxhash64(big_key)).join(heavy, _HASH, "left")
        .withColumn(_PIECE, piece).drop(_HASH, _PIECES)
    )
    pieces = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(_PIECES), F.lit(1).cast("long")) - 1)
    right = (
        table.withColumn(_HASH, F.xxhash64(_KEY)).join(heavy, _HASH, "left")
        .select(*table.columns, F.explode(pieces).alias("__piece_r"))
    )
    same = (F.col(f"l.`{big_key}`") == F.col(f"r.{_KEY}")) & (F.col(f"l.{_PIECE}") == F.col("r.__piece_r"))
    return left.alias("l"), right.alias("r"), same


def _of(side: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{side}.`{c}`") for c in columns]


def _distinct(keys: DataFrame, key: str) -> DataFrame:
    return keys.select(F.col(key).alias(_KEY)).where(F.col(_KEY).isNotNull()).distinct()


def lookup_join(big: DataFrame, table: DataFrame, big_key: str, key: str, how: str = "inner",
                heavy_rows: int = HEAVY_ROWS, heavy: DataFrame | None = None) -> DataFrame:
    """``big`` with the other columns of ``table`` where its ``key`` is the row's (``how``: inner or left).

    ``heavy`` is the list of heavy keys, if it is known already.
    """
    found = heavy_keys(big, big_key, heavy_rows) if heavy is None else heavy
    left, right, same = _dealt(big, table.where(F.col(key).isNotNull()).withColumnRenamed(key, _KEY), big_key, found)
    return left.join(right, same, how).select(*_of("l", big.columns), *_of("r", [c for c in table.columns if c != key]))


def semi_join(big: DataFrame, keys: DataFrame, big_key: str, key: str,
              heavy_rows: int = HEAVY_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Rows of ``big`` whose ``big_key`` occurs in ``keys[key]``.

    ``counted`` is a cheaper relation with a column ``big_key`` to find the
    heavy keys in (by default ``big``).
    """
    heavy = heavy_keys(big if counted is None else counted, big_key, heavy_rows)
    left, right, same = _dealt(big, _distinct(keys, key), big_key, heavy)
    # The key side is distinct, so an inner join returns a row at most once; unlike
    # a semi join it is not pushed into every branch of a union below it.
    return left.join(right, same, "inner").select(*_of("l", big.columns))
