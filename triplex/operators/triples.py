"""Whole-table triple operators: dedup, counts, cleaning, object parts.

Dedup and counting are hash aggregates with a map-side partial step, so a
triple repeated millions of times collapses inside each map task before
anything is shuffled: a hot duplicate never lands whole on one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplex.functions.clean import (
    clean_object,
    clean_predicate,
    clean_subject,
    object_datatype,
    object_id,
    object_lang,
    predicate_tail,
)
from triplex.operators.joins import HEAVY_ROWS, heavy_of_counts, lookup_join
from triplex.schema import OBJECT, PREDICATE, SUBJECT, TRIPLE_COLUMNS
from triplex.session import stored

#: Characters of the longest value that is its own key where only counts are wanted.
KEY_CHARS = 64


def drop_duplicate_triples(df: DataFrame) -> DataFrame:
    """Exact whole-triple dedup (before cleaning, as the source data is)."""
    return df.dropDuplicates(TRIPLE_COLUMNS)


def triple_multiplicity(raw: DataFrame, min_count: int = 2) -> DataFrame:
    """Triples that occur at least ``min_count`` times, with their count ``n``."""
    return (
        raw.groupBy(*TRIPLE_COLUMNS)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def bounded_key(c: Column | str) -> Column:
    """A value as a key of bounded size, null for null: itself up to ``KEY_CHARS`` characters, else its SHA-256.

    Counting distinct values needs no texts; a task's hash table then grows
    with its rows, not with the length of what they hold.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > KEY_CHARS, F.concat(F.lit("#"), F.sha2(c, 256))).otherwise(F.concat(F.lit("="), c))


def duplicate_counts(raw: DataFrame) -> DataFrame:
    """One row ``raw_count, dedup_count, duplicate_count`` from one shuffle of bounded keys."""
    per_triple = raw.groupBy(*[bounded_key(c).alias(c) for c in TRIPLE_COLUMNS]).agg(F.count(F.lit(1)).alias("n"))
    return per_triple.agg(
        F.sum("n").cast("long").alias("raw_count"),
        F.count(F.lit(1)).alias("dedup_count"),
    ).select(
        "raw_count",
        "dedup_count",
        (F.col("raw_count") - F.col("dedup_count")).alias("duplicate_count"),
    )


def clean_triples(df: DataFrame) -> DataFrame:
    """Replace the three columns by their cleaned form; other columns are kept.

    One projection with native expressions: no Python, one pass, and the
    optimizer can push a later predicate filter below it.
    """
    extra = [c for c in df.columns if c not in TRIPLE_COLUMNS]
    return df.select(
        clean_subject(SUBJECT).alias(SUBJECT),
        clean_predicate(PREDICATE).alias(PREDICATE),
        clean_object(OBJECT).alias(OBJECT),
        *extra,
    )


def mapping_conflicts(mapping: DataFrame) -> DataFrame:
    """``old, news``: predicates that ``mapping (old, new)`` sends to more than one new name."""
    return (
        mapping.where(F.col("old").isNotNull()).groupBy("old")
        .agg(F.array_sort(F.collect_set("new")).alias("news")).where(F.size("news") > 1)
    )


def clean_triples_mapped(df: DataFrame, mapping: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """:func:`clean_triples` with a vocabulary mapping given as a relation ``(old, new)`` of any size.

    The mapping replaces the built-in one.  It meets the distinct predicates
    only; the rows then look up the raw spellings that it changes (a stored
    relation, so the planner knows its size; predicates of very many rows are
    split).  Pairs without an old or a new name say nothing; a name with two
    new ones is an error.
    """
    pairs = stored(mapping.where("old IS NOT NULL AND new IS NOT NULL").select("old", "new").distinct(), "mapping")
    conflicts = mapping_conflicts(pairs).orderBy("old").limit(5).collect()
    if conflicts:
        raise ValueError("conflicting mapping: " + "; ".join(f"{r['old']} -> {', '.join(r['news'])}" for r in conflicts))
    names = df.select(F.col(PREDICATE).alias("_raw")).where(F.col("_raw").isNotNull()).groupBy("_raw").agg(
        F.count(F.lit(1)).alias("__n")
    ).select("_raw", "__n", F.when(F.col("__n") > 0, predicate_tail("_raw")).alias("_tail"))
    changed = stored(names.join(pairs, F.col("_tail") == F.col("old")).select("_raw", "new", "__n"), "mapped-predicates")
    heavy = heavy_of_counts(changed.select(F.xxhash64("_raw").alias("__hash"), "__n"), heavy_rows)
    rows = lookup_join(df, changed.select("_raw", F.col("new").alias("_new")), PREDICATE, "_raw", "left", heavy=heavy)
    extra = [c for c in df.columns if c not in TRIPLE_COLUMNS]
    return rows.select(
        clean_subject(SUBJECT).alias(SUBJECT),
        F.coalesce("_new", predicate_tail(PREDICATE)).alias(PREDICATE),
        clean_object(OBJECT).alias(OBJECT),
        *extra,
    )


def object_parts(df: DataFrame) -> DataFrame:
    """Cleaned triple plus what the object cleaning throws away.

    ``object_raw`` (the original value), ``object_id`` (a URI object under
    the subject rule), ``object_lang`` and ``object_datatype``.
    """
    o = F.col(OBJECT)
    return df.select(
        clean_subject(SUBJECT).alias(SUBJECT),
        clean_predicate(PREDICATE).alias(PREDICATE),
        clean_object(o).alias(OBJECT),
        o.alias("object_raw"),
        object_id(o).alias("object_id"),
        object_lang(o).alias("object_lang"),
        object_datatype(o).alias("object_datatype"),
    )
