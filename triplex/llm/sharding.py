"""Sharding by proportional stratified interleaving (operator 10).

Within each source, rows are put in a seeded random order and ranked.  A row
with rank ``r`` of the ``n`` rows of its source gets the fraction
``(r + 0.5) / n``; all rows sorted by that fraction interleave the sources in
proportion, so any contiguous cut holds the mixture of the whole.  The order
is cut into shards whose row counts differ by one at most.

Neither rank comes from a window over a whole source or table.  Rows fall
into ``buckets`` equal ranges of the random order (or of the fraction), which
are even for a source of any size; the counts of earlier buckets (at most
``buckets`` per source) plus the rank inside the bucket give the exact rank.

Defined results: null text has size 1 and the CRC of no bytes; null sources
are one source; repeated rows are rows of their own (equal random keys are
ordered by id, then text checksum); an empty table gives no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import materialise

#: Ranges that an order is cut into for counting; a constant of the method.
BUCKETS = 4096
#: Seed of the order within a source.
SEED = 17


def shuffle_key(seed: int, id_col) -> F.Column:
    """32 hex digits that order the rows of a source at random, by seed and id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list, rank: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in the order of ``bucket``, then ``order``, inside ``group``."""
    counts = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        *[F.col(c).alias(f"_b_{c}") for c in (*group, bucket)],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    on = F.lit(True)
    for c in (*group, bucket):
        on = on & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return (
        rows.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(before, on)
        .withColumn(rank, (F.col("_before") + F.col("_inside")).cast("long"))
        .drop("_inside", "_before", *[f"_b_{c}" for c in (*group, bucket)])
    )


def interleave(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, source, size, text_crc32, position``: every row's place in the interleaved order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = shuffle_key(seed, F.col(id_col))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        key.alias("key"),
    )
    span = 2.0**32 / buckets
    rows = materialise(
        rows.withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / span).cast("int")),
        "shard-rows",
    )
    ranked = _ranked(rows, ["source"], "bucket", ["key", "doc_id", "text_crc32"], "rank")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_rows")).withColumnRenamed("source", "_source")
    fraction = (F.col("rank") + F.lit(0.5)) / F.col("_rows")
    # The number of sources is not bounded, so nothing is broadcast by hint;
    # adaptive execution measures the table and splits a hot source otherwise.
    spread = (
        materialise(ranked, "shard-ranks")
        .join(materialise(sizes, "shard-sources"), F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "doc_id", "source", "size", "text_crc32", "key",
            fraction.alias("fraction"),
            F.least(F.floor(fraction * buckets), F.lit(buckets - 1)).cast("int").alias("slice"),
        )
    )
    order = [F.col("fraction"), F.col("source").asc_nulls_first(), "key", "doc_id", "text_crc32"]
    placed = _ranked(materialise(spread, "shard-fractions").withColumn("_all", F.lit(0)), ["_all"], "slice", order, "position")
    return placed.select("doc_id", "source", "size", "text_crc32", "position")


def assign_shards(docs: DataFrame, shards: int = 16, **columns) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` by cutting the interleaved order evenly."""
    placed = materialise(interleave(docs, **columns), "shard-places")
    rows = placed.count()
    # Shard s holds positions ceil(s * rows / shards) up to the next shard's start.
    shard = F.expr(f"position * {shards} div {max(rows, 1)}").cast("int")
    first = F.expr(f"(shard * cast({rows} as long) + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("position") - first).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", **columns) -> None:
    """Write the whole rows as one Parquet folder per shard, each sorted by slot.

    Ids are taken to be unique here; the writing tasks are ranges of
    ``(shard, slot)``, so a shard is as many files as its bytes need.
    """
    places = assign_shards(docs, shards, id_col=id_col, **columns).select(
        F.col("doc_id").alias("_place_id"), "shard", "slot"
    )
    plain = docs.drop("shard", "slot")
    (
        plain.join(places, F.col(id_col).cast("long") == F.col("_place_id"))
        .drop("_place_id")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
