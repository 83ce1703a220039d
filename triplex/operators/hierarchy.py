"""Predicate hierarchy as a flat relation ``(path, parent, part, depth, is_leaf)``.

A dotted predicate ``a.b.c`` contributes the nodes ``a``, ``a.b`` and
``a.b.c``.  A node is a leaf when no predicate continues below it, which is
the "empty sub-dictionary" rule of a nested template, computed as one
aggregate over exploded prefixes instead of a tree walk on one machine.

Rules kept from the template semantics:
* a predicate that is also a prefix of another (``a.b`` with ``a.b.c``) is
  not a leaf;
* only dots split (``a.b-x`` is a sibling of ``a.b``); empty parts are kept;
* a domain without dotted predicates has no leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.functions.clean import domain_of, path_parts, path_prefix
from triplex.operators.vocabulary import predicate_counts, unique_predicates
from triplex.schema import PREDICATE


def prefix_rows(preds: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Explode every dotted prefix of ``Predicate`` into one node row.

    ``has_child`` is true when the node is a strict prefix of the predicate
    that produced the row.
    """
    extra = extra or []
    parts = path_parts(PREDICATE)
    n = F.size(parts)
    node = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            path_prefix(parts, i).alias("path"),
            F.when(i > 1, path_prefix(parts, i - 1)).alias("parent"),
            F.element_at(parts, i).alias("part"),
            i.cast("long").alias("depth"),
            (i < n).alias("has_child"),
        ),
    )
    src = preds.where(F.col(PREDICATE).isNotNull())
    return src.select(*extra, F.explode(node).alias("_node")).select(*extra, "_node.*")


def predicate_hierarchy(cl: DataFrame) -> DataFrame:
    """All nodes of the predicate tree with their leaf flag.

    One aggregate over the exploded prefixes of the distinct predicates: a
    node is a leaf when no predicate continues below it.  No join.
    """
    nodes = prefix_rows(unique_predicates(cl))
    return nodes.groupBy("path", "parent", "part", "depth").agg(
        (~F.max("has_child")).alias("is_leaf")
    )


def hierarchy_sizes(cl: DataFrame) -> DataFrame:
    """Per node: distinct predicates and triples in its subtree (itself included)."""
    counts = predicate_counts(cl)
    return (
        prefix_rows(counts, extra=["n"])
        .groupBy("path", "depth")
        .agg(F.count(F.lit(1)).alias("n_predicates"), F.sum("n").cast("long").alias("n_triples"))
    )


def _leaves(vocab: DataFrame) -> DataFrame:
    return (
        prefix_rows(vocab)
        .groupBy("path")
        .agg(F.max("has_child").alias("_inner"))
        .where(~F.col("_inner"))
        .select(F.col("path").alias(PREDICATE))
    )


def leaf_predicates(cl: DataFrame) -> DataFrame:
    """Predicates that are not a strict dotted prefix of another predicate."""
    return _leaves(unique_predicates(cl))


def domain_leaves(cl: DataFrame, domain: str, strict: bool = False) -> DataFrame:
    """Leaf predicates under ``domain`` (the domain node itself excluded).

    Lazy; only the domain's predicates are exploded.  An unknown domain
    gives an empty relation, or raises with ``strict``.
    """
    p = F.col(PREDICATE)
    vocab = unique_predicates(cl).where(p.isNotNull() & (domain_of(p) == domain))
    if strict and not vocab.take(1):
        raise KeyError(domain)
    return _leaves(vocab).where(F.col(PREDICATE).contains("."))
