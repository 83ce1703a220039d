"""Predicate vocabulary: unique predicates, domains, positions, keyword search.

Every operator first reduces the triples to one row per predicate (a
partial + final hash aggregate), so a predicate carried by a third of all
triples costs one row per map task in the shuffle, never a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.functions.clean import domain_of
from triplex.schema import PREDICATE

# Bits of monotonically_increasing_id() that hold the row number inside a
# partition (the partition index sits above them).
_LOCAL_BITS = 33


def unique_predicates(cl: DataFrame) -> DataFrame:
    """Distinct predicates (NULL included once, as ``distinct`` does)."""
    return cl.select(PREDICATE).distinct()


def predicate_counts(cl: DataFrame) -> DataFrame:
    """``Predicate, n``: triples per predicate, pre-aggregated map side."""
    return cl.groupBy(PREDICATE).agg(F.count(F.lit(1)).alias("n"))


def domain_counts(cl: DataFrame) -> DataFrame:
    """Per domain (text before the first dot): distinct predicates and triples."""
    return (
        predicate_counts(cl)
        .groupBy(domain_of(PREDICATE).alias("domain"))
        .agg(
            F.count(PREDICATE).alias("n_predicates"),
            F.sum("n").cast("long").alias("n_triples"),
        )
    )


def top_domains(cl: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` domains with most distinct predicates (ties by name).

    ``orderBy + limit`` plans as a distributed top-k (TakeOrderedAndProject).
    """
    return domain_counts(cl).orderBy(F.desc("n_predicates"), F.asc("domain")).limit(k)


def keyword_predicates(vocab: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """One row per (predicate, keyword) substring hit, sorted.

    A predicate matching two keywords appears twice, a repeated keyword
    repeats its hits.  The keyword list is a literal array evaluated per
    row, so there is no join at all.
    """
    p = F.col(PREDICATE)
    if not keywords:
        return vocab.select(p, F.lit(None).cast("string").alias("keyword")).where(F.lit(False))
    kw = F.array(*[F.lit(k) for k in keywords])
    return (
        vocab.where(p.isNotNull())
        .select(p, F.explode(F.filter(kw, lambda k: p.contains(k))).alias("keyword"))
        .orderBy(PREDICATE, "keyword")
    )


def ordered_positions(df: DataFrame, column: str, position: str = "position") -> DataFrame:
    """0-based position of each distinct non-null value in sorted order.

    Distributed: values are range-partitioned and sorted inside each
    partition, numbered locally with ``monotonically_increasing_id`` and
    shifted by the sizes of the preceding partitions.  Only the per-partition
    counts (one row per partition) meet in one place; the numbered values
    are checkpointed so both uses read the same partitioning.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = (
        values.repartitionByRange(n_parts, column)
        .sortWithinPartitions(column)
        .select(column, F.monotonically_increasing_id().alias("_mid"))
        .select(
            column,
            F.shiftright("_mid", _LOCAL_BITS).alias("_pid"),
            F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_local"),
        )
    )
    from triplex.session import checkpoint_root

    checkpoint_root(spark)
    numbered = numbered.checkpoint(eager=True)
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: bounded by the partition count.
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_offset"),
    )
    return numbered.join(F.broadcast(offsets), "_pid").select(
        column, (F.col("_offset") + F.col("_local")).cast("long").alias(position)
    )


def predicate_positions(cl: DataFrame) -> DataFrame:
    """Sorted unique predicates with their 0-based row position."""
    return ordered_positions(cl, PREDICATE)
