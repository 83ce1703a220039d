"""Lines that are no triple: every line is accepted or rejected, with its reason."""

import os

import pytest

from triplex.session import scratch_path
from triplex.sources.triples import read_triples, read_triples_checked

GOOD = ["<s>\t<p>\t\"x\"@en\t.", "<s>\t<p>\t\"a b\"\t.", "é\tp\t\\\"q\\\"\t.", "s\tp\t  blanks  \t."]
BAD = {
    "two\tfields": "field count", "one": "field count", "a\tb\tc\t.\t.": "field count", "a\tb\tc": "field count",
    "\tp\to\t.": "missing value", "s\t\to\t.": "missing value", "s\tp\t\t.": "missing value", "s\tp\to\t;": "no end mark",
    "s\tp\to\t": "no end mark", "   ": "blank line", "": "blank line",
}


@pytest.fixture
def dump(spark):
    path = scratch_path(spark, "t-rejects")
    os.makedirs(path)
    lines = [x for pair in zip(GOOD * 3, list(BAD) + [GOOD[0]]) for x in pair]
    with open(f"{path}/a.tsv", "w") as f:
        f.write("\n".join(lines) + "\n")
    return path, lines


@pytest.mark.parametrize("mode", ["compat", "ntriples"])
def test_rows_and_rejects_are_all_lines(spark, dump, mode):
    path, lines = dump
    found = read_triples_checked(spark, path, mode)
    rejects = [tuple(r) for r in found.rejects.collect()]
    assert found.triples.count() + len(rejects) == len(lines)
    assert sorted(rejects) == sorted((x, BAD[x]) for x in lines if x in BAD)
    counts = {r["metric"]: r["value"] for r in found.counts().collect()}
    assert counts.pop("lines") == len(lines) == sum(counts.values())
    assert counts["accepted"] == found.triples.count()


@pytest.mark.parametrize("mode", ["compat", "ntriples"])
def test_accepted_rows_are_those_of_the_plain_scan(spark, dump, mode):
    path, lines = dump
    clean = scratch_path(spark, "t-good")
    spark.createDataFrame([(x,) for x in lines if x not in BAD], "v string").write.text(clean)
    want = sorted(map(tuple, read_triples(spark, clean, mode).collect()))
    assert sorted(map(tuple, read_triples_checked(spark, path, mode).triples.collect())) == want


def test_empty_dump(spark):
    path = scratch_path(spark, "t-empty")
    spark.createDataFrame([], "v string").write.text(path)
    found = read_triples_checked(spark, path)
    assert found.triples.count() == found.rejects.count() == 0
    assert [tuple(r) for r in found.counts().collect()] == [("lines", 0)]
    with pytest.raises(ValueError):
        read_triples_checked(spark, path, mode="other")


def test_a_run_writes_and_counts_rejects(spark, dump):
    from triplex.__main__ import main

    path, lines = dump
    report = main(["--input", path, "--mode", "ntriples", "--no-sample", "--check-lines"], spark=spark)
    bad = sum(x in BAD for x in lines)
    assert report["counters"]["rejectCount"] == bad
    assert report["counters"]["initCount"] == len(lines) - bad
    assert spark.read.parquet(report["paths"]["rejects"]).count() == bad
