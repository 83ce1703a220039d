"""Delimited exports, read modes, merge, hierarchy files."""

import os

import pytest
from helpers import triples_df

from triplex.schema import PREDICATE_LIST_SCHEMA, TRIPLE_SCHEMA
from triplex.session import scratch_path
from triplex.sinks.delimited import merge_parts, read_hierarchy, write_delimited, write_hierarchy, write_triples
from triplex.sources.triples import read_parts, read_triples

TRICKY = [
    ("a|b", ' "q" ', "back\\slash"),
    ("", None, "multi\nline"),
    ("  lead", "trail  ", '"Foo"@en'),
    ("x", "y", "z"),
    ("\\N", "\\\\N", "\\"),
]


def test_lossless_round_trip(spark):
    path = scratch_path(spark, "t-lossless")
    write_delimited(triples_df(spark, TRICKY), path, lossless=True)
    back = [tuple(r) for r in read_parts(spark, path, TRIPLE_SCHEMA, lossless=True).collect()]
    assert sorted(back, key=repr) == sorted(TRICKY, key=repr)


def test_default_export_is_lossy_in_known_ways(spark):
    path = scratch_path(spark, "t-default")
    write_delimited(triples_df(spark, [("  lead", "", "x")]), path)
    r = read_parts(spark, path, TRIPLE_SCHEMA).first()
    assert (r.Subject, r.Predicate, r.Object) == ("lead", None, "x")


def test_tsv_read_modes(spark):
    d = scratch_path(spark, "t-tsv")
    os.makedirs(d)
    with open(os.path.join(d, "part.tsv"), "w") as f:
        f.write('<s>\t<p>\t"plain"\t.\n<s>\t<p>\t"Foo bar"@en\t.\n<s>\t<p>\t"He said \\"hi\\" to"@fr\t.\n')
    compat = [r.Object for r in read_triples(spark, d, "compat").collect()]
    exact = [r.Object for r in read_triples(spark, d, "ntriples").collect()]
    assert exact == ['"plain"', '"Foo bar"@en', '"He said \\"hi\\" to"@fr']
    assert compat[0] == "plain" and compat[1] == '"Foo bar"@en'
    assert compat[2] == '"He said "hi" to"@fr'  # default CSV escaping consumes the backslashes
    with pytest.raises(ValueError):
        read_triples(spark, d, "other")


def test_escaped_tsv_round_trip(spark):
    tricky = [("a\tb", "p", "one\rtwo\nthree"), ("\\t", "\\\\n", "\\"), ("x\\\t", "\\\\\\r", "y"), ("s", "p", "\\N")]
    path = scratch_path(spark, "t-escaped")
    write_triples(triples_df(spark, tricky), path)
    back = read_triples(spark, path, "ntriples", escaped=True)
    assert sorted(map(tuple, back.collect())) == sorted(tricky)


def test_merge_parts(spark):
    parts = scratch_path(spark, "t-parts")
    df = spark.createDataFrame([(f"p{i:03d}",) for i in range(50)], PREDICATE_LIST_SCHEMA).repartition(4)
    write_delimited(df, parts)
    out = scratch_path(spark, "t-merged")
    merged = merge_parts(spark, parts, out, PREDICATE_LIST_SCHEMA, header=True, sort=True)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 1
    lines = open(os.path.join(out, files[0])).read().splitlines()
    assert lines[0] == "Predicate" and lines[1:] == [f"p{i:03d}" for i in range(50)]
    assert merged.count() == 50
    out2 = scratch_path(spark, "t-merged2")
    merge_parts(spark, parts, out2, PREDICATE_LIST_SCHEMA, header=True, sort=True, file_chars=60)
    names = sorted(f for f in os.listdir(out2) if f.startswith("part-"))
    read = [open(os.path.join(out2, f)).read().splitlines() for f in names]
    assert 1 < len(names) <= 5 and all(x[0] == "Predicate" for x in read)
    assert [p for x in read for p in x[1:]] == [f"p{i:03d}" for i in range(50)]
    out3 = scratch_path(spark, "t-merged3")
    merge_parts(spark, parts, out3, PREDICATE_LIST_SCHEMA, header=True, index_header=True)
    f3 = [f for f in os.listdir(out3) if f.startswith("part-")][0]
    assert open(os.path.join(out3, f3)).readline().strip() == "0"


def test_hierarchy_files(spark):
    from triplex.operators.hierarchy import predicate_hierarchy

    h = predicate_hierarchy(triples_df(spark, [("s", "a.b", "o")]))
    path = scratch_path(spark, "t-hier")
    write_hierarchy(h, path)
    assert sorted(map(tuple, read_hierarchy(spark, path).collect())) == sorted(map(tuple, h.collect()))


def test_lossless_merge_round_trip(spark):
    parts = scratch_path(spark, "t-lparts")
    df = triples_df(spark, TRICKY).repartition(3)
    write_delimited(df, parts, lossless=True)
    merged = merge_parts(spark, parts, scratch_path(spark, "t-lmerged"), TRIPLE_SCHEMA, header=True, lossless=True)
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(TRICKY, key=repr)


def test_gzip_dump_with_spread(spark):
    import gzip

    d = scratch_path(spark, "t-gz")
    os.makedirs(d)
    lines = [f"<s{i % 50}>\t<p{i % 3}>\t\"o{i % 7}\"@en\t." for i in range(2000)]
    with gzip.open(os.path.join(d, "dump.tsv.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")
    plain = read_triples(spark, d, "ntriples")
    spread = read_triples(spark, d, "ntriples", spread=8)
    assert plain.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == 8
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect()))
    assert spread.dropDuplicates().count() == len(set(lines))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="\\tnr\t\n\r\u0001a", max_size=12), min_size=1, max_size=60))
def test_line_escapes_are_undone(spark, texts):
    from triplex.sources.triples import escape_field, unescape_field

    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "x string")
    escaped = df.select("x", escape_field("x").alias("y"))
    found = escaped.select("x", "y", unescape_field("y").alias("z")).collect()
    assert all(r["x"] == r["z"] for r in found)
    assert all(not set("\t\n\r") & set(r["y"] or "") for r in found)
