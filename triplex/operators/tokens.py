"""Token operators over a text column (triples' objects, documents, turns).

The tokenizer, stop-word filter and length rule are column functions from
``triplex.functions.text``; these operators add the columns and the token
statistics.  Token frequency is one hash aggregate by token with a map-side
partial step, so a very common token never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.functions.text import (
    long_only_stop_words,
    remove_stop_words,
    token_count,
    tokenize,
)
from triplex.schema import OBJECT
from triplex.session import stored

STOP_MODES = ("none", "all", "long_only")


def with_tokens(df: DataFrame, text: str, stop_words: str = "long_only", out: str = "tokens") -> DataFrame:
    """Append ``out`` tokens of ``text``.

    ``none``: tokens only.  ``all``: stop words removed from every row.
    ``long_only``: stop words removed only when the text has 50+ characters.
    """
    if stop_words not in STOP_MODES:
        raise ValueError(f"stop_words must be one of {STOP_MODES}")
    tokens = tokenize(text)
    if stop_words == "all":
        tokens = remove_stop_words(tokens)
    elif stop_words == "long_only":
        tokens = long_only_stop_words(tokens, text)
    return df.withColumn(out, tokens)


def triple_tokens(cl: DataFrame) -> DataFrame:
    """Cleaned triples with ``tokenizedObj`` and ``filtered_tokens`` columns.

    ``filtered_tokens`` follows the documented intent (stop words removed
    from objects of 50+ characters).
    """
    tokenized = tokenize(OBJECT)
    return cl.withColumns(
        {
            "tokenizedObj": tokenized,
            "filtered_tokens": long_only_stop_words(tokenized, OBJECT),
        }
    )


def token_frequency(df: DataFrame, text: str, id_col: str, stop_words: str = "none") -> DataFrame:
    """Per token: occurrences ``n`` and number of distinct ids ``n_rows`` whose rows hold it.

    Rows may share an id; a null id adds occurrences only.  Each row gives its
    tokens and then its distinct tokens; the place tells which is which, so one
    aggregate by token alone, combined map side, counts occurrences and rows.
    Only rows whose id really repeats (found in the id column alone) need their
    distinct pairs of token and id.
    """
    repeated = stored(
        df.select(F.col(id_col).alias("_again")).where(F.col(id_col).isNotNull())
        .groupBy("_again").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_again"),
        "repeated-ids",
    )
    toks = with_tokens(df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), "_text", stop_words, "_t")
    rows = toks.select("_id", "_t")
    twice = repeated.take(1)
    if twice:
        rows = rows.join(repeated, F.col("_id") == F.col("_again"), "left")
    else:
        rows = rows.withColumn("_again", F.lit(None).cast("string"))
    both = F.concat("_t", F.array_distinct("_t"))
    flat = rows.select("_id", "_again", F.size("_t").alias("_n"), F.posexplode(both).alias("_at", "token")).select(
        "token", "_id", "_again", (F.col("_at") >= F.col("_n")).alias("_first")
    )
    own = F.col("_first") & F.col("_id").isNotNull() & F.col("_again").isNull()
    counts = flat.groupBy("token").agg(F.count(F.when(~F.col("_first"), 1)).alias("n"), F.count(F.when(own, 1)).alias("n_rows"))
    if not twice:
        return counts
    shared = flat.where(F.col("_first") & F.col("_again").isNotNull()).select("token", "_id").distinct()
    more = shared.groupBy("token").agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("n_rows"))
    return counts.unionByName(more).groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"))


__all__ = ["with_tokens", "triple_tokens", "token_frequency", "token_count"]
