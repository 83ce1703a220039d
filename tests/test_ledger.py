"""Run counters as rows: retries and second runs replace, inputs add up."""

from helpers import triples_df

from triplex.plans import ledger
from triplex.plans.batch import ExportConfig, input_name, run_batch
from triplex.session import scratch_path


def totals(spark, path):
    return {r["metric"]: r["value"] for r in ledger.totals(ledger.read(spark, path)).collect()}


def test_a_retry_replaces_its_rows(spark):
    path = scratch_path(spark, "t-ledger")
    ledger.record(spark, path, "r1", {"a.tsv": {"initCount": 10, "sample": 1}})
    ledger.record(spark, path, "r1", {"a.tsv": {"initCount": 12}})
    assert totals(spark, path) == {"initCount": 12}
    assert ledger.read(spark, path).count() == 1


def test_a_second_run_over_an_input_replaces_and_other_inputs_add_up(spark):
    path = scratch_path(spark, "t-ledger")
    ledger.record(spark, path, "r1", {"a.tsv": {"initCount": 10}, "b.tsv": {"initCount": 5}})
    ledger.record(spark, path, "r2", {"a.tsv": {"initCount": 11}})
    assert totals(spark, path) == {"initCount": 16}
    now = {(r["input"], r["run_id"]): r["value"] for r in ledger.current(ledger.read(spark, path)).collect()}
    assert now == {("a.tsv", "r2"): 11, ("b.tsv", "r1"): 5}
    ledger.record(spark, path, "r3", {None: {"initCount": 1}})
    assert totals(spark, path) == {"initCount": 17}


def test_runs_record_their_counters(spark):
    path = scratch_path(spark, "t-ledger")
    one = triples_df(spark, [(f"s{i % 7}", "common.topic.alias", f"o{i % 9}") for i in range(200)])
    two = triples_df(spark, [("s", "common.topic.alias", "o")] * 3)
    runs = [run_batch(spark, df, ExportConfig(ledger_path=path, run_id=r, input_name=n))
            for df, r, n in ((one, "a", "one"), (two, "b", "two"), (one, "a", "one"), (one, "c", "one"))]
    assert runs[0].counters["initCount"] == 200 and runs[0].counters["finalCount"] == 63
    assert totals(spark, path) == {k: runs[0].counters[k] + runs[1].counters[k] for k in runs[0].counters}


def test_counters_do_not_depend_on_how_often_tasks_ran(spark):
    """The counts are those of the committed table."""
    raw = triples_df(spark, [("s", "p", "o")] * 5 + [("s", "p", None)] * 2 + [(None, None, None)])
    result = run_batch(spark, raw, ExportConfig(export_sample=False))
    assert result.counters == {"initCount": 8, "finalCount": 3}
    empty = run_batch(spark, raw.limit(0), ExportConfig())
    assert empty.counters == {"initCount": 0, "finalCount": 0, "domainCount": 0, "sample": 0}


def test_input_names(spark, sf_small):
    files = spark.read.parquet(f"{sf_small}/region.parquet")
    assert input_name(files).endswith("region.parquet") and input_name(files) == input_name(files)
    both = files.select("r_name").union(spark.read.parquet(f"{sf_small}/nation.parquet").select("n_name"))
    assert input_name(both).startswith("2 files ")
    assert input_name(spark.range(1)) == "table"
