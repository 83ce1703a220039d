"""Exact deduplication with a heavy-hitter split (operator 9).

1. Every text becomes its SHA-256 digest, once, in the scan; only
   ``(doc_id, row_id, digest)`` is stored.
2. A Misra-Gries summary per partition finds frequent digests.  Summed over
   partitions, a summary of ``2 / share`` counters undercounts a digest by at
   most ``N * share / 2``, so every digest with ``N * share`` rows or more is
   among those with a summed count of ``N * share / 2`` or more, and at most
   ``2 / share`` digests can reach that.
3. The candidates are counted exactly.  Those that do have ``N * share`` rows
   (at most ``1 / share`` digests) are the winners; their table is broadcast
   and settles their rows in the scan, without any shuffle of those rows.
4. Every other digest has fewer than ``N * share`` rows, so an ordinary
   shuffle on the digest has no hot key.

Defined results: null text counts as empty; among equal texts the largest
``doc_id`` stays (a null id loses to any id); of rows that repeat both id and
text exactly one stays, the one read last; an empty table gives no rows;
other columns are ignored whatever their names; a text of any length counts
whole, by its digest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import id_and_text, keep_decided, long_ids, materialise

#: A digest is a heavy hitter from this share of all rows on.
HEAVY_SHARE = 1 / 1024


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, row_id, digest)`` of every row; the digest is 32 bytes."""
    return long_ids(id_and_text(docs, id_col, text_col)).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row_id"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )


def _misra_gries(counters: int):
    """Partition summary: ``(digest, lower bound of its count)``, at most ``counters`` rows."""

    def summarise(batches):
        table: dict[bytes, int] = {}
        for pdf in batches:
            for digest, n in pdf["digest"].value_counts(sort=False).items():
                table[digest] = table.get(digest, 0) + int(n)
            if len(table) > counters:
                counts = np.fromiter(table.values(), np.int64, len(table))
                cut = int(np.partition(counts, -counters - 1)[-counters - 1])
                table = {k: n - cut for k, n in table.items() if n > cut}
        yield pd.DataFrame({"digest": list(table), "at_least": np.array(list(table.values()), np.int64)})

    return summarise


def heavy_digests(digests: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """``(digest, keep, n)`` of the digests with ``share`` of the rows or more (two rows at least)."""
    rows = digests.count()
    counters = int(np.ceil(2 / share))
    candidates = (
        digests.select("digest")
        .mapInPandas(_misra_gries(counters), "digest binary, at_least long")
        .groupBy("digest").agg(F.sum("at_least").alias("at_least"))
        .where(F.col("at_least") >= rows * share / 2)
        .select("digest")
    )
    verified = (
        digests.join(F.broadcast(materialise(candidates, "heavy-candidates")), "digest")
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= max(2, rows * share))
    )
    return materialise(verified, "heavy-digests")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = HEAVY_SHARE
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``."""
    digests = materialise(text_digests(docs, id_col, text_col), "digests")
    heavy = heavy_digests(digests, share)
    same = Window.partitionBy("digest")
    settled = digests.join(F.broadcast(heavy), "digest")
    others = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "*",
        F.max(F.struct("doc_id", "row_id")).over(same).alias("keep"),
        F.count(F.lit(1)).over(same).alias("n"),
    )
    return settled.unionByName(others).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("keep.row_id") == F.col("row_id")).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, without the copies that :func:`exact_dedup` drops.

    Rows are told apart by id and text; of rows that repeat both one stays.
    """
    decided = exact_dedup(docs, id_col, text_col).groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")
    )
    return keep_decided(docs, decided, id_col, text_col)
