"""Domain filter and domain samples.

A domain's triples are those whose predicate is one of its leaves: of the
data's own vocabulary, or of a maintained one given as a hierarchy relation.
The filter is one lazy plan.  The domain's prefix reaches the Parquet scan; a
4 KB bitmap of the wanted predicates, a scalar subquery that Spark runs with
the query, drops other rows before any shuffle; and a join with the
predicates, hot ones split, settles what is left exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplex.functions.clean import clean_predicate, domain_of
from triplex.operators.bitmap import bitmap_of, maybe_in
from triplex.operators.hierarchy import domain_leaves, prefix_rows
from triplex.operators.joins import semi_join
from triplex.operators.triples import clean_triples, drop_duplicate_triples
from triplex.schema import OBJECT, PREDICATE, SUBJECT, TRIPLE_COLUMNS

SAMPLE_UNIT = "_sample_unit"
# Bits of the filter's bitmap; a fixed size, whatever the vocabulary.
BITMAP_BITS = 1 << 15
# Rows of one predicate, with their texts, that one task of the filter may get.
HOT_ROWS = 100_000
_TWO_32 = 4294967296


def sample_unit(s: Column | str = SUBJECT, p: Column | str = PREDICATE, o: Column | str = OBJECT) -> Column:
    """First 32 bits of ``md5(s TAB p TAB o)`` as a number in ``[0, 2^32)``.

    Computed on the raw (pre-cleaning) triple, which is unique after dedup,
    so rows that cleaning makes equal still get independent draws.  The
    value is a pure function of the row: a re-run task, a re-partitioned
    input or another engine draws the same rows.
    """
    key = F.concat_ws("\t", s, p, o)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def filter_to_predicates(df: DataFrame, predicates: DataFrame) -> DataFrame:
    """Rows of ``df`` whose predicate is in ``predicates`` (exact, case-sensitive; a null predicate is in none)."""
    wanted = predicates.select(F.col(PREDICATE).alias("_wanted")).where(F.col("_wanted").isNotNull())
    near = df.where(maybe_in(bitmap_of(wanted, "_wanted", BITMAP_BITS), F.col(PREDICATE), BITMAP_BITS))
    # Most of a domain can be rows of one predicate: those are split.
    return semi_join(near, wanted, PREDICATE, "_wanted", HOT_ROWS)


def leaves_of(cl: DataFrame | None, domain: str, hierarchy: DataFrame | None = None) -> DataFrame:
    """The leaf predicates of ``domain``: of a given hierarchy relation, else of the triples ``cl``."""
    if hierarchy is None:
        return domain_leaves(cl, domain)
    path = F.col("path")
    return hierarchy.where(F.col("is_leaf") & path.contains(".") & (domain_of(path) == domain)).select(path.alias(PREDICATE))


def domain_triples(
    cl: DataFrame, domain: str, vocab_from: DataFrame | None = None, hierarchy: DataFrame | None = None
) -> DataFrame:
    """Cleaned triples whose predicate is a leaf of ``domain``.

    ``vocab_from`` is the relation the leaves are computed from (defaults to
    ``cl`` itself); pass a narrow relation such as a materialised predicate
    list to avoid a second wide scan.  With ``hierarchy``, a maintained
    vocabulary, the data's own one is not read at all.
    """
    leaves = leaves_of(vocab_from if vocab_from is not None else cl, domain, hierarchy)
    # Every leaf starts with the domain: in files sorted by predicate the scan skips the others' row groups.
    return filter_to_predicates(cl.where(F.col(PREDICATE).startswith(domain + ".")), leaves)


def raw_predicates_of_domain(raw: DataFrame, domain: str, hierarchy: DataFrame | None = None) -> DataFrame:
    """Raw predicate values whose cleaned form is a leaf of ``domain``.

    The cleaning regex runs on the distinct raw predicates only (a map-side
    combined aggregate), never per triple.
    """
    # Reading an aggregate keeps the regex above it; one that repeated rows do not
    # change lets Catalyst drop a dedup below it.
    cleaned = F.when(F.col("_n") >= 0, clean_predicate("_raw"))
    vocab = (
        raw.select(F.col(PREDICATE).alias("_raw")).where(F.col("_raw").isNotNull())
        .groupBy("_raw").agg(F.max(F.length("_raw")).alias("_n"))
        .select("_raw", cleaned.alias(PREDICATE)).where(domain_of(PREDICATE) == domain)
    )
    if hierarchy is not None:
        leaves = leaves_of(None, domain, hierarchy).select(F.col(PREDICATE).alias("_leaf"))
        # An inner join (not a semi join) keeps the test above the distinct.
        return vocab.join(leaves.distinct(), F.col(PREDICATE) == F.col("_leaf")).select(F.col("_raw").alias(PREDICATE))
    # Every dotted prefix of each cleaned predicate, the raw value carried
    # along; a cleaned predicate is a leaf when no row with the same path
    # has a child.  One aggregate, combined map side: an inner path (the domain
    # itself, above all) carries one flag, and only a predicate's own path
    # carries its raw spellings.
    nodes = prefix_rows(vocab, extra=["_raw"]).where(F.col("path").contains("."))
    flagged = nodes.groupBy("path").agg(
        F.max("has_child").alias("_inner"), F.collect_set(F.when(~F.col("has_child"), F.col("_raw"))).alias("_raws")
    )
    return flagged.where(~F.col("_inner")).select(F.explode("_raws").alias(PREDICATE))


def raw_domain_rows(raw: DataFrame, domain: str, hierarchy: DataFrame | None = None) -> DataFrame:
    """Raw triples of ``domain``: a filter on the raw predicate column.

    Applied before dedup and cleaning, so only the domain's rows are shuffled.
    """
    return filter_to_predicates(raw, raw_predicates_of_domain(raw, domain, hierarchy))


def domain_triples_from_raw(raw: DataFrame, domain: str, hierarchy: DataFrame | None = None) -> DataFrame:
    """Same rows as ``domain_triples(clean_triples(drop_duplicate_triples(raw)), domain)``.

    The vocabulary is read from the raw predicate column; on a columnar
    source that is one narrow column, on a text dump it is a further full
    read, so repeated domain work should run on the Parquet table written by
    the batch run (``plans.batch``), where the filter is pushed into the scan.
    """
    return clean_triples(drop_duplicate_triples(raw_domain_rows(raw.select(*TRIPLE_COLUMNS), domain, hierarchy)))


def domain_sample_hash(dedup_raw: DataFrame, domain: str, fraction: float) -> DataFrame:
    """Repeatable Bernoulli sample of a domain's cleaned triples.

    Keeps a row when its raw-triple hash unit is below ``fraction * 2^32``.
    Filter-only: no shuffle, no state, identical on every re-run.  The
    domain test runs on the raw predicate (see ``raw_domain_rows``).
    """
    picked = raw_domain_rows(dedup_raw.select(*TRIPLE_COLUMNS), domain)
    sampled = picked.where(sample_unit() < F.lit(fraction * _TWO_32))
    return clean_triples(sampled).select(*TRIPLE_COLUMNS)


def domain_sample_random(cl: DataFrame, domain: str, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement (Spark ``sample``).

    Repeatable only for a fixed seed *and* an unchanged input partitioning;
    prefer ``domain_sample_hash`` when the sample is counted and written by
    separate actions or must survive task retries after a shuffle.
    """
    return domain_triples(cl, domain).sample(withReplacement=False, fraction=fraction, seed=seed)
