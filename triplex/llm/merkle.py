"""Merkle dataset manifest by nested-interval labels (operator 11).

Every row is a leaf: the SHA-256 of its encoded columns.  The rows of one tree
(here: one language) get leaf ranks in key order, and every node is labelled
with the interval ``[lo, hi)`` of the leaf ranks that it covers, so the whole
manifest is a relation of ``(tree, level, lo, hi, digest)`` and no pointer is
followed anywhere.

* Ranks: rows are dealt out by range and sorted; a row's rank is its place in
  its partition, less the place where its tree starts there, plus the tree's
  rows in earlier partitions.  Only one count for each tree and partition
  meets elsewhere, so a tree that holds most rows is spread like any other.
* Build: a level groups the nodes of the level below by the bucket
  ``lo div 8^level``, at most eight to a group.  The subroots form one more
  tree of the same kind.
* Ancestors: from the top down, a containment join inside the buckets of a
  level finds the node whose interval holds a node's own.  The difference of
  the two intervals splits the parent's children into the siblings on the left
  and those on the right.  A leaf thus carries its path, one
  ``(left, right)`` pair a level.

Each level is a table in the shared folder, an eighth of the one before.

Defined results: a null value is ``-``, an empty one has length 0; rows
without an order key come first; rows that share it are ordered by their leaf
digest; repeated rows are leaves of their own (equal digests at neighbouring
ranks); an empty table gives no rows; other columns are ignored whatever their
names; a text of any length is hashed whole, inside its own row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import materialise

# Children of a node; columns of a leaf, in order.
FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_LOCAL_BITS = 33  # bits of monotonically_increasing_id below the partition's number
_PATH = "array<struct<left:string,right:string>>"


def field(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, ``:`` and the value."""
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the encoded values, concatenated."""
    return F.sha2(F.concat(*[field(v.cast("string")) for v in values]), 256)


@dataclass
class Tree:
    """Trees of one family: ``leaves`` and a table of inner nodes for each level.

    ``leaves`` has ``tree, lo, hi, n, digest, payload`` (``n``: leaves of the
    tree); a level has ``tree, n, bucket, lo, hi, digest, children``.  The
    node with ``lo = 0`` and ``hi = n`` is the tree's root.
    """

    leaves: DataFrame
    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """``tree, digest`` of every tree's root."""
        found = self.leaves.where("n = 1").select("tree", "digest")
        for level in self.levels:
            found = found.unionByName(level.where("lo = 0 AND hi = n").select("tree", "digest"))
        return found

    def nodes(self) -> DataFrame:
        """``tree, level, lo, hi, digest`` of all nodes, leaves at level 0."""
        columns = ["tree", "level", "lo", "hi", "digest"]
        found = self.leaves.withColumn("level", F.lit(0)).select(*columns)
        for k, level in enumerate(self.levels, 1):
            found = found.unionByName(level.withColumn("level", F.lit(k)).select(*columns))
        return found


@dataclass
class Manifest:
    """The trees of a dataset and the tree over their subroots (its payload: the tree's name)."""

    trees: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row: ``digest`` of the whole dataset (no row for an empty one)."""
        return self.top.roots().select("digest")


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``tree, lo, hi, n, digest, payload`` of ``rows (tree, *order, digest, payload)``, and the largest ``n``."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["tree", *order, "digest", "row"]
    dealt = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .select("tree", "digest", "payload", F.monotonically_increasing_id().alias("place"))
    )
    placed = materialise(
        dealt.select(
            "tree", "digest", "payload",
            F.shiftright("place", _LOCAL_BITS).alias("part"),
            F.col("place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("at"),
        ),
        "merkle-places",
    )
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(
        placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")).select(
            "tree", "part",
            (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(whole).alias("n"),
        ),
        "merkle-offsets",
    )
    lo = F.col("at") + F.col("shift")
    leaves = placed.join(offsets, ["tree", "part"]).select(
        "tree", lo.alias("lo"), (lo + 1).alias("hi"), "n", "digest", "payload"
    )
    return leaves, offsets.agg(F.max("n")).first()[0] or 0


def build(rows: DataFrame, order: list[str], fanout: int = FANOUT) -> Tree:
    """The trees over ``rows (tree, *order, digest, payload)``."""
    leaves, largest = ranked(rows, order)
    levels: list[DataFrame] = []
    nodes, width = leaves, 1
    while width < largest:
        child = F.struct(*[c for c in ("lo", "hi", "digest", "payload") if c in nodes.columns])
        runs = (
            nodes.where(F.col("n") > width)
            .groupBy("tree", "n", F.expr(f"lo div {width * fanout}").alias("bucket"))
            .agg(F.array_sort(F.collect_list(child)).alias("children"))
        )
        levels.append(materialise(
            runs.select(
                "tree", "n", "bucket",
                F.col("children")[0]["lo"].alias("lo"),
                F.element_at("children", -1)["hi"].alias("hi"),
                F.sha2(F.array_join(F.col("children.digest"), ""), 256).alias("digest"),
                "children",
            ),
            f"merkle-level-{len(levels) + 1}",
        ))
        nodes, width = levels[-1], width * fanout
    return Tree(leaves, levels)


def siblings(children, lo, hi) -> Column:
    """The difference of a parent's interval and ``[lo, hi)``: digests on the left and on the right."""

    def digests(keep) -> Column:
        return F.array_join(F.transform(F.filter(children, keep), lambda x: x["digest"]), "")

    return F.struct(
        digests(lambda x: x["hi"] <= lo).alias("left"), digests(lambda x: x["lo"] >= hi).alias("right")
    )


def paths(tree: Tree, above: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """Every leaf's ``digest, payload``, its ``path`` and ``top``, the digest of its tree's root.

    ``above`` (``tree, path`` and other columns, one row a tree) holds what
    lies over the roots; its paths are appended and its other columns kept.
    """
    carry = [] if above is None else [c for c in above.columns if c not in ("tree", "path")]

    def rooted(nodes: DataFrame, *columns: str) -> DataFrame:
        if above is None:
            nodes = nodes.withColumn("path", F.array().cast(_PATH))
        else:
            nodes = nodes.join(above, "tree")
        return nodes.select(*columns, F.col("digest").alias("top"), "path", *carry)

    up = None
    for k in range(len(tree.levels), 0, -1):
        level = tree.levels[k - 1]
        found = rooted(level.where("lo = 0 AND hi = n"), "tree", "lo", "hi", "children")
        if up is not None:
            bucket = F.expr(f"lo div {fanout ** (k + 1)}").alias("bucket")
            parent = up.select(
                "tree", bucket, F.col("lo").alias("plo"), F.col("hi").alias("phi"),
                F.col("children").alias("around"), "top", "path", *carry,
            )
            own = level.select("tree", bucket, "lo", "hi", "children")
            inside = own.join(parent, ["tree", "bucket"]).where("plo <= lo AND hi <= phi")
            step = F.array(siblings(F.col("around"), F.col("lo"), F.col("hi")))
            found = found.unionByName(inside.select(
                "tree", "lo", "hi", "children", "top", F.concat(step, "path").alias("path"), *carry
            ))
        up = found
    single = rooted(tree.leaves.where("n = 1"), "digest", "payload")
    if up is None:
        return single
    leaf = F.col("leaf")
    below = up.select("*", F.explode("children").alias("leaf")).select(
        leaf["digest"].alias("digest"), leaf["payload"].alias("payload"), "top",
        F.concat(F.array(siblings(F.col("children"), leaf["lo"], leaf["hi"])), "path").alias("path"), *carry,
    )
    return below.unionByName(single)


def manifest(
    docs: DataFrame, fields=FIELDS, tree_col: str = "lang", order_col: str = "doc_id",
    changed: dict[str, Column] | None = None, where: Column | None = None,
) -> Manifest:
    """The manifest of ``docs``: one tree for each value of ``tree_col``, and the tree of their subroots.

    The payload of a leaf is its order key and, for audits, ``changed``: the
    leaf of the row with the columns in ``changed`` replaced, where ``where`` holds.
    """
    other = F.lit(None).cast("string")
    if changed:
        leaf = leaf_digest([changed.get(c, F.col(c)) for c in fields])
        other = leaf if where is None else F.when(where, leaf)
    rows = docs.select(
        # Null first, then bytewise: a mark before each name keeps that order.
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),
        F.col(order_col).alias("key"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        F.struct(F.col(order_col).alias("key"), other.alias("changed")).alias("payload"),
    )
    trees = build(materialise(rows, "merkle-leaves"), ["key"])
    subroots = materialise(trees.roots(), "merkle-subroots")
    top = build(
        subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.struct(F.col("tree").alias("key")).alias("payload")),
        ["key"],
    )
    return Manifest(trees, top)


def proofs(found: Manifest) -> DataFrame:
    """``key, leaf, changed, subroot, root, path`` of every leaf; the path leads to the root of the dataset."""
    above = paths(found.top).select(
        F.col("payload.key").alias("tree"), "path", F.col("top").alias("root")
    )
    return paths(found.trees, materialise(above, "merkle-subroot-paths")).select(
        F.col("payload.key").alias("key"), F.col("digest").alias("leaf"), F.col("payload.changed").alias("changed"),
        F.col("top").alias("subroot"), "root", "path",
    )


def proof_digest(path="path") -> Column:
    """Hex SHA-256 of the siblings along a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf, path="path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def audit(
    docs: DataFrame, changed: dict[str, Column] | None = None, where: Column | None = None,
    fields=FIELDS, tree_col: str = "lang", order_col: str = "doc_id",
) -> DataFrame:
    """Each row's proof against the manifest of ``docs``, checked with its changed leaf where it has one.

    ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.
    """
    found = proofs(manifest(docs, fields, tree_col, order_col, changed, where))
    checked = found.select(
        "key", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf")).alias("folded_root"),
    )
    return checked.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))
