"""Exact top-k inner-product search by MaxScore (operator 4).

A vector's components are its terms and their integer weights.  Vectors fall
into shards by a hash of their row, and queries into blocks, so that a task
holds one shard and one block whatever the table's size.  A shard keeps its
postings term by term, with the smallest and largest weight of each, which
bound what a term can add to a query's score.

For each query the terms are ordered by the width of their bounds.  A few
scored rows give a first threshold; the narrowest terms whose widths together
cannot lift a row from the lowest possible score to the threshold are
non-essential.  The postings of the essential terms are traversed; the other
terms are probed only for rows that can still reach the threshold, a few at a
time, and rows that fall behind leave.  Every shard reports its best k, and
the merge of all shards keeps the best k of a query.  The result is exact.

Weights are floor(256 * x).  Defined results: vectors that are null or hold a
null or non-finite component take no part; a shorter vector lacks the other
terms (weight 0); an empty vector scores 0 with everything; a row is never its
own candidate, nor is a row with the same id; ties go to the smaller id and
repeated rows are candidates of their own; an empty table gives no rows;
other columns are ignored whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import materialise

#: Rows of a shard and queries of a block, on average.
SHARD_ROWS = 16384
BLOCK_QUERIES = 4096
SCALE = 256
#: Rows scored for a query's first threshold, and terms probed at a time.
SEEDS = 64
PROBED = 8


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, w``: integer weights of the vectors that take part."""
    v = F.col("v")
    wrong = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & v.isNotNull())
        .where(~wrong)
        .select("vec_id", F.transform(v, lambda x: F.floor(x * scale)).alias("w"))
    )


def _pack(pdf: pd.DataFrame) -> tuple[bytes, bytes, int]:
    """Ids, the postings (one row of weights per term) and their number, rows in the order of ids."""
    pdf = pdf.sort_values("vec_id", kind="stable")
    terms = max(map(len, pdf["w"]), default=0)
    weights = np.zeros((len(pdf), terms), np.int64)
    for i, w in enumerate(pdf["w"]):
        weights[i, : len(w)] = w
    return pdf["vec_id"].to_numpy(np.int64).tobytes(), np.ascontiguousarray(weights.T).tobytes(), terms


def packed(rows: DataFrame, part: str, parts: int) -> DataFrame:
    """One row per part: ``part, ids, postings, terms``; rows fall into parts by a hash of their row number."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(pdf[part].iloc[0], *_pack(pdf))], columns=[part, "ids", "postings", "terms"])

    placed = rows.withColumn(part, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int"))
    return placed.groupBy(part).applyInPandas(pack, f"{part} int, ids binary, postings binary, terms int")


def _kth(scores: np.ndarray, k: int):
    """The k-th highest score, or None if there are fewer."""
    return None if len(scores) < k else np.partition(scores, len(scores) - k)[len(scores) - k]


def shard_top(ids: np.ndarray, post: np.ndarray, query_id: int, q: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """``(ids, scores)`` of the best ``k`` rows of a shard for one query, by MaxScore.

    ``post`` holds one row of weights per term; ``low`` and ``high`` are the
    smallest and largest weight of each.  ``ids`` ascend.
    """
    ends = np.stack([q * low, q * high])
    least = ends.min(axis=0)
    width = ends.max(axis=0) - least
    order = np.argsort(-width, kind="stable")
    widths = width[order]
    rest = np.concatenate([np.cumsum(widths[::-1])[::-1], [0]])  # what the terms from a place on can add at most
    floor_ = np.concatenate([np.cumsum(least[order][::-1])[::-1], [0]])  # what they add at least
    seeds = np.flatnonzero(ids != query_id)[:SEEDS]
    bound = _kth(q @ post[:, seeds], k)
    # Terms from `split` on are non-essential: the lowest score plus all their widths stays below the bound.
    split = len(order) if bound is None else int(np.argmax(floor_[0] + rest < bound)) if (floor_[0] + rest < bound).any() else len(order)
    essential = order[:split]
    part = q[essential] @ post[essential] if split else np.zeros(len(ids), post.dtype)
    rows = np.flatnonzero(ids != query_id)
    part = part[rows]
    at = split
    while True:
        lowest = _kth(part + floor_[at], k)
        if lowest is not None:
            bound = lowest if bound is None else max(bound, lowest)
            stay = part + floor_[at] + rest[at] >= bound
            rows, part = rows[stay], part[stay]
        if at >= len(order):
            break
        probe = order[at : at + PROBED]
        part = part + q[probe] @ post[np.ix_(probe, rows)]
        at += len(probe)
    best = np.lexsort((ids[rows], -part))[:k]
    return ids[rows[best]], part[best]


def _searched(k: int):
    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(block):
            ids = np.frombuffer(shard["ids"].iloc[0], np.int64)
            post = np.frombuffer(shard["postings"].iloc[0], np.int64).reshape(-1, len(ids))
            query_ids = np.frombuffer(block["ids"].iloc[0], np.int64)
            queries = np.frombuffer(block["postings"].iloc[0], np.int64).reshape(-1, len(query_ids))
            terms = max(len(post), len(queries))  # terms that one side lacks have weight 0
            post = np.vstack([post, np.zeros((terms - len(post), len(ids)), np.int64)])
            queries = np.vstack([queries, np.zeros((terms - len(queries), len(query_ids)), np.int64)])
            largest = float(np.abs(post).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, terms)
            if largest < 2**51:  # sums are then exact as doubles, whose products are faster
                post, queries = post.astype(np.float64), queries.astype(np.float64)
            low, high = post.min(axis=1, initial=np.inf if post.dtype == float else 2**62), post.max(axis=1, initial=-np.inf if post.dtype == float else -(2**62))
            for j, query_id in enumerate(query_ids.tolist()):
                found, scores = shard_top(ids, post, query_id, np.ascontiguousarray(queries[:, j]), low, high, k)
                out.append(pd.DataFrame({"query_id": query_id, "copy": j, "vec_id": found, "score": scores.astype(np.int64)}))
        if not out:
            return pd.DataFrame({"query_id": [], "block": [], "copy": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(out, ignore_index=True).assign(block=int(block["block"].iloc[0]))[
            ["query_id", "block", "copy", "vec_id", "score"]
        ]

    return search


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``vectors`` for every row of ``queries``."""
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors, id_col, vector_col), "vectors")
    asked = materialise(quantised(queries, id_col, vector_col), "queries")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(spread, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))
    cut = materialise(packed(rows, "shard", shards), "shards")
    block = materialise(packed(asked, "block", blocks), "blocks")
    left = cut.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = block.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        _searched(k), "query_id long, block int, copy int, vec_id long, score long"
    )
    best = Window.partitionBy("query_id", "block", "copy").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
