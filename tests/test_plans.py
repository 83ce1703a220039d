"""Plan shape of every registered query: native expressions, no products."""

import pytest

import __spark_entry__ as entry
from triplex.operators.domains import domain_triples
from triplex.plans.batch import materialise_cleaned
from triplex.plans.catalogue import QUERIES
from triplex.session import scratch_path
from triplex.sources.tables import raw_triples

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_or_product(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_domain_filter_reaches_parquet_scan(spark, sf_small):
    cleaned = materialise_cleaned(raw_triples(spark, sf_small), scratch_path(spark, "t-cleaned"))
    found = domain_triples(cleaned, "people")
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]
    assert any("Subject" in s and "StringStartsWith(Predicate,people.)" in s for s in scans), scans
    assert found.count() == cleaned.where("Predicate IN ('people.person.name', 'people.person.nationality')").count() > 0


def test_vocabulary_reads_one_column(spark, sf_small):
    from triplex.operators.vocabulary import domain_counts

    cleaned = materialise_cleaned(raw_triples(spark, sf_small), scratch_path(spark, "t-cleaned2"))
    plan = domain_counts(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Predicate:string>" in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["domain", "n_predicates", "n_triples"] and df.count() > 0
