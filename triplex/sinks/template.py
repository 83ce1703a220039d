"""The predicate hierarchy as nested documents, one top-level domain a line.

A line is ``{"domain": {"part": {...}}}``; an empty object is a leaf.  The flat
relation stays the form that scales (``write_hierarchy``); this one is for tools
that read nested templates.  A domain is one line, so its tree is put together
in one row; levels are folded and unfolded by Spark, all domains at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplex.functions.clean import path_prefix
from triplex.session import stored


def _quoted(c: str) -> Column:
    """A string as a JSON string."""
    as_object = F.to_json(F.struct(F.col(c).alias("k")))  # {"k":"..."}
    return as_object.substr(F.lit(6), F.length(as_object) - 6)


def template_lines(hierarchy: DataFrame) -> DataFrame:
    """``part, value``: one nested document for each domain of a hierarchy relation.

    Folded from the deepest level up: the documents of the nodes with one
    parent become the members of its object, in the order of their names.
    """
    nodes = stored(hierarchy.select("path", "parent", "part", "depth"), "template-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    below: DataFrame | None = None  # parent, members
    for depth in range(deepest, 0, -1):
        level = nodes.where(F.col("depth") == depth)
        if below is None:
            docs = level.withColumn("doc", F.lit("{}"))
        else:
            docs = level.join(below.withColumnRenamed("parent", "path"), "path", "left").withColumn(
                "doc", F.coalesce("members", F.lit("{}"))
            )
        member = F.struct("part", F.concat(_quoted("part"), F.lit(":"), "doc").alias("member"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(member)), lambda m: m["member"]), ",")
        if depth == 1:
            return docs.select("part", F.concat(F.lit("{"), _quoted("part"), F.lit(":"), "doc", F.lit("}")).alias("value"))
        below = docs.groupBy("parent").agg(F.concat(F.lit("{"), joined, F.lit("}")).alias("members"))
    return nodes.select("part", F.col("path").alias("value")).where(F.lit(False))


def write_template(hierarchy: DataFrame, path: str) -> None:
    """Write a hierarchy relation as nested documents, one domain a line."""
    template_lines(hierarchy).select("value").write.mode("overwrite").text(path)


def read_template(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The hierarchy relation of nested documents: ``path, parent, part, depth, is_leaf``.

    A line may hold one domain or several.  Level by level the members of all
    objects become rows, until no object has any; a member with an empty (or no)
    object is a leaf.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    open_nodes = lines.select(F.array().cast("array<string>").alias("parts"), F.parse_json("value").alias("v"))
    found = None
    while True:
        members = open_nodes.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).where("key IS NOT NULL")
        level = stored(
            members.select(F.concat("parts", F.array("key")).alias("parts"), F.to_json("value").alias("doc")), "template-level"
        )
        if not level.take(1):
            break
        found = level if found is None else found.unionByName(level)
        open_nodes = level.select("parts", F.parse_json("doc").alias("v"))
    if found is None:
        found = lines.select(F.array().cast("array<string>").alias("parts"), F.col("value").alias("doc")).where(F.lit(False))
    n = F.size("parts")
    return found.select(
        path_prefix(F.col("parts"), n).alias("path"),
        F.when(n > 1, path_prefix(F.col("parts"), n - 1)).alias("parent"),
        F.try_element_at("parts", F.lit(-1)).alias("part"),
        n.cast("long").alias("depth"),
        (~F.col("doc").rlike(r"^\{.+\}$")).alias("is_leaf"),
    ).groupBy("path", "parent", "part", "depth").agg(F.bool_and("is_leaf").alias("is_leaf"))
