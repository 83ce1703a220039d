"""Node, edge and model tables of the triple graph (input: ``object_parts``).

All three are grouped aggregates with bounded per-group state (min,
counts); no per-node collection of an unbounded set is built, so a node
that owns a large share of the triples costs the same as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.functions.clean import clean_predicate, clean_subject, object_id
from triplex.operators.joins import HEAVY_ROWS, heavy_keys, semi_join
from triplex.schema import OBJECT, PREDICATE, SUBJECT
from triplex.session import stored

# --- FIXED VALUES: predicates that carry node attributes ---------------------
NAME_PREDICATE = "type.object.name"
TYPE_PREDICATE = "type.object.type"


def graph_nodes(parts: DataFrame) -> DataFrame:
    """One row per subject: ``node_id, name, n_types, n_triples``.

    ``name`` is the smallest cleaned name object; ``n_types`` counts the
    distinct type ids.  Types are few rows of their own, made distinct and
    counted beside the other aggregates, so no row is doubled for them; both
    sides are dealt by subject already when they meet.
    """
    p = F.col(PREDICATE)
    nodes = parts.where(F.col(SUBJECT).isNotNull()).groupBy(F.col(SUBJECT).alias("node_id")).agg(
        F.min(F.when(p == NAME_PREDICATE, F.col(OBJECT))).alias("name"),
        F.count(F.lit(1)).alias("n_triples"),
    )
    types = (
        graph_node_types(parts).where(F.col("node_id").isNotNull())
        .groupBy("node_id").agg(F.count(F.lit(1)).alias("n_types"))
    )
    return nodes.join(types, "node_id", "left").select(
        "node_id", "name", F.coalesce("n_types", F.lit(0)).cast("long").alias("n_types"), "n_triples"
    )


def write_by_subject(
    parts: DataFrame, name: str, path: str, buckets: int | None = None, heavy_rows: int = HEAVY_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Store ``object_parts`` rows by subject: a bucketed table ``name`` under ``path``, and the other rows.

    Work per subject then needs no exchange of the bucketed table.  A bucket
    is read by one task, so subjects of more than ``heavy_rows`` rows (a
    bounded list) and rows without a subject are kept in a plain table beside it.
    The rows are computed once and stored; the count and both tables read them.
    """
    spark = parts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(parts, "parts")
    heavy = stored(heavy_keys(parts, SUBJECT, heavy_rows), "heavy-subjects")
    apart, rest = parts.where(F.col(SUBJECT).isNull()), parts.where(F.col(SUBJECT).isNotNull())
    if not heavy.isEmpty():
        marked = rest.withColumn("__hash", F.xxhash64(SUBJECT)).join(F.broadcast(heavy), "__hash", "left")
        split = F.col("__pieces").isNotNull()
        apart = apart.unionByName(marked.where(split).select(*parts.columns))
        rest = marked.where(~split).select(*parts.columns)
    apart.write.parquet(f"{path}/heavy")
    (
        rest.repartition(buckets, SUBJECT)
        .write.format("parquet").option("path", f"{path}/bucketed").bucketBy(buckets, SUBJECT).sortBy(SUBJECT)
        .saveAsTable(name)
    )
    return spark.table(name), spark.read.schema(parts.schema).parquet(f"{path}/heavy")


def graph_nodes_by_subject(bucketed: DataFrame, heavy: DataFrame) -> DataFrame:
    """:func:`graph_nodes` of a table stored by subject; only the few heavy subjects are exchanged, combined map side."""
    return graph_nodes(bucketed).unionByName(graph_nodes(heavy))


def subject_as_object_by_subject(bucketed: DataFrame, heavy: DataFrame) -> DataFrame:
    """Triples whose subject appears as an object id, of a table stored by subject.

    The distinct ids go to the buckets; the rows stay where they are.  The
    distinct heavy subjects, a bounded list, are looked up and broadcast.
    """
    ids = bucketed.select("object_id").unionByName(heavy.select("object_id")).where("object_id IS NOT NULL").select(
        F.col("object_id").alias("_id")
    ).distinct()
    columns = [SUBJECT, PREDICATE, OBJECT]
    found = bucketed.join(ids, F.col(SUBJECT) == F.col("_id"), "left_semi").select(*columns)
    named = heavy.select(F.col(SUBJECT).alias("_s")).where("_s IS NOT NULL").distinct()
    named = F.broadcast(named.join(ids, F.col("_s") == F.col("_id"), "left_semi"))
    return found.unionByName(heavy.join(named, F.col(SUBJECT) == F.col("_s"), "left_semi").select(*columns))


def graph_node_types(parts: DataFrame) -> DataFrame:
    """``node_id, type_id`` pairs, distinct (the node's type set as rows)."""
    return (
        parts.where((F.col(PREDICATE) == TYPE_PREDICATE) & F.col("object_id").isNotNull())
        .select(F.col(SUBJECT).alias("node_id"), F.col("object_id").alias("type_id"))
        .distinct()
    )


def graph_edges(parts: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Distinct ``src, predicate, dst`` where the object id is itself a subject.

    Edges are made distinct first (map-side combined) and then meet the
    distinct subjects; a node that is the target of very many of them (a type,
    a country) is split.
    """
    links = (
        parts.where(F.col("object_id").isNotNull())
        .select(F.col(SUBJECT).alias("src"), F.col(PREDICATE).alias("predicate"), F.col("object_id").alias("dst"))
        .distinct()
    )
    return semi_join(links, parts.select(SUBJECT), "dst", SUBJECT, heavy_rows)


def graph_edges_from_raw(raw: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``graph_edges(object_parts(drop_duplicate_triples(raw)))`` without the dedup of the triples.

    Edges are distinct cleaned values, so the raw dedup is not needed.  They
    are made distinct (combined map side) before the join, so copies never
    meet it.  A hot target is split; targets are counted in the raw rows, one
    narrow column.
    """
    links = raw.select(
        clean_subject(SUBJECT).alias("src"),
        clean_predicate(PREDICATE).alias("predicate"),
        object_id(OBJECT).alias("dst"),
    ).where(F.col("dst").isNotNull())
    subjects = raw.select(clean_subject(SUBJECT).alias(SUBJECT))
    return semi_join(links.distinct(), subjects, "dst", SUBJECT, heavy_rows, counted=links.select("dst"))


def graph_model(parts: DataFrame) -> DataFrame:
    """Per predicate: triples, distinct subjects, link and literal counts."""
    return parts.groupBy(PREDICATE).agg(
        F.count(F.lit(1)).alias("n_triples"),
        F.countDistinct(SUBJECT).alias("n_subjects"),
        F.count("object_id").alias("n_links"),
        (F.count(F.lit(1)) - F.count("object_id")).alias("n_literals"),
    )
