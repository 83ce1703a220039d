"""Nested templates, mappings as relations, triples by header name, tables stored by subject."""

import json
import uuid

import pytest
from helpers import one_col, triples_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triplex.operators import graph, triples
from triplex.operators.hierarchy import predicate_hierarchy
from triplex.operators.matching import subject_as_object
from triplex.schema import SUBJECT
from triplex.session import scratch_path
from triplex.sinks.delimited import write_delimited
from triplex.sinks.template import read_template, template_lines, write_template
from triplex.sources.triples import read_named_csv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def nested(paths):
    """The template as a dict, one level a dotted part."""
    out = {}
    for path in paths:
        node = out
        for part in path.split("."):
            node = node.setdefault(part, {})
    return out


PATHS = ["a.b", "a.b.c", "a.d", "x", 'q"u\\o.te.s', "é.日", ".x", "a..z", "a.b.c.d.e.f"]


def test_template_lines_are_the_nested_dict(spark):
    hierarchy = predicate_hierarchy(one_col(spark, "Predicate", PATHS + [None]))
    found = [json.loads(r["value"]) for r in template_lines(hierarchy).collect()]
    assert all(len(x) == 1 for x in found)
    assert {k: v for x in found for k, v in x.items()} == nested(PATHS)


_paths = st.lists(st.lists(st.sampled_from(["a", "b", "", "é", '"', "\\", "{}", "1"]), min_size=1, max_size=4).map(".".join), max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_paths)
def test_template_round_trip(spark, paths):
    hierarchy = predicate_hierarchy(one_col(spark, "Predicate", paths))
    path = scratch_path(spark, "t-template")
    write_template(hierarchy, path)
    assert rows(read_template(spark, path)) == rows(hierarchy)


def test_templates_from_elsewhere(spark):
    path = scratch_path(spark, "t-template")
    spark.createDataFrame([('{"a": {"b": {}, "c": null}, "d": {}}',), ("",), ('{"e": {"f": {"g": {}}}}',)], "v string").write.text(path)
    found = {r["path"]: r["is_leaf"] for r in read_template(spark, path).collect()}
    assert found == {"a": False, "a.b": True, "a.c": True, "d": True, "e": False, "e.f": False, "e.f.g": True}


NS = "<http://rdf.freebase.com/ns/"


def test_mapping_relation(spark):
    raw = triples_df(spark, [
        ("s", f"{NS}old.a>", "o"), ("s", "old.b", '"x"@en'), ("s", f"{NS}keep>", "o"), ("s", None, "o"),
        ("s", "<http://www.w3.org/2000/01/rdf-schema#label>", "o"),
    ] + [(f"s{i}", f"{NS}old.a>", "o") for i in range(50)])
    mapping = spark.createDataFrame(
        [("old.a", "new.a"), ("old.a", "new.a"), ("old.b", "new.b"), ("never", "x"), (None, "y"), ("keep", None)], "old string, new string"
    )
    for heavy in (10**6, 3):
        found = triples.clean_triples_mapped(raw, mapping, heavy)
        assert found.groupBy("Predicate").count().collect() and {r["Predicate"]: r["count"] for r in found.groupBy("Predicate").count().collect()} == {
            "new.a": 51, "new.b": 1, "keep": 1, None: 1, "rdf-schema#label": 1,
        }
    builtin = spark.createDataFrame([("rdf-schema#label", "type.object.name"), ("rdf-syntax-ns#type", "type.object.type")], "old string, new string")
    assert rows(triples.clean_triples_mapped(raw, builtin)) == rows(triples.clean_triples(raw))
    assert rows(triples.clean_triples_mapped(raw, builtin.limit(0)).select("Subject")) == rows(raw.select("Subject"))


def test_mapping_conflicts_are_an_error(spark):
    mapping = spark.createDataFrame([("a", "b"), ("a", "c"), ("d", "e"), ("d", "e")], "old string, new string")
    assert rows(triples.mapping_conflicts(mapping)) == [("a", ["b", "c"])]
    with pytest.raises(ValueError, match="a -> b, c"):
        triples.clean_triples_mapped(triples_df(spark, [("s", "a", "o")]), mapping)


def test_columns_by_header_name(spark):
    data = [("s1", 'p,"1"', "o\n1"), ("s2", "", None), ("\\N", "\\x", " b ")]
    out = triples_df(spark, data).select(F.col("Object").alias("dst obj"), F.lit(1).alias("n"), F.col("Subject").alias("src"), F.col("Predicate").alias("p q"))
    path = scratch_path(spark, "t-named")
    write_delimited(out.repartition(2), path, sep=",", header=True, lossless=True)
    columns = {"Subject": "src", "Predicate": "p q", "Object": "dst obj"}
    assert rows(read_named_csv(spark, path, columns)) == sorted(data, key=repr)
    with pytest.raises(ValueError, match="no column"):
        read_named_csv(spark, path, columns | {"Object": "absent"})
    with pytest.raises(ValueError, match="no header name"):
        read_named_csv(spark, path, {"Subject": "src"})
    write_delimited(out.select("src", "dst obj", "n", "p q"), path, sep=",", header=True, lossless=True, mode="append")
    with pytest.raises(Exception, match="(?i)header"):  # files of two headers are not mixed up
        read_named_csv(spark, path, columns).collect()


def _parts(spark, n=3000):
    hot = f"{NS}m.hot>"
    data = [(hot if i % 3 == 0 else f"{NS}m.{i % 500}>", f"{NS}type.object.{'type' if i % 2 else 'name'}>",
             f"{NS}m.{i % 40}>" if i % 2 else f'"n{i % 11}"@en') for i in range(n)] + [(None, "p", hot), (None, "p", "x")]
    return triples.object_parts(triples.drop_duplicate_triples(triples_df(spark, data)))


def test_storing_by_subject_computes_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    parts = _parts(spark, 600).where(F.col(SUBJECT).isNotNull())
    n = parts.count()
    once = parts.mapInPandas(count, parts.schema)
    bucketed, rest = graph.write_by_subject(
        once, f"t_{uuid.uuid4().hex}", scratch_path(spark, "t-once"), 4
    )
    assert rows(bucketed) == rows(parts) and rest.count() == 0
    assert seen.value == n


@pytest.mark.parametrize("heavy", [20, 10**6])
def test_tables_stored_by_subject(spark, heavy):
    parts = _parts(spark)
    bucketed, rest = graph.write_by_subject(parts, f"t_{uuid.uuid4().hex}", scratch_path(spark, "t-by-subject"), 4, heavy)
    assert rows(bucketed.unionByName(rest)) == rows(parts)
    assert rest.where(F.col(SUBJECT).isNotNull()).select(SUBJECT).distinct().count() == (heavy == 20)
    assert rows(graph.graph_nodes_by_subject(bucketed, rest)) == rows(graph.graph_nodes(parts))
    assert rows(graph.subject_as_object_by_subject(bucketed, rest)) == rows(subject_as_object(parts))
    plan = graph.graph_nodes(bucketed)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    joined = bucketed.join(bucketed.select(F.col("object_id").alias("i")).distinct(), F.col(SUBJECT) == F.col("i"), "left_semi")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(i") <= 2
