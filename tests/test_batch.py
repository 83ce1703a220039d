"""The batch run: one materialised pass, exports, counters and metrics."""

import os

from triplex.plans.batch import ExportConfig, run_batch, run_counters
from triplex.sources.tables import raw_triples


def test_run_batch_counters_and_exports(spark, sf_small):
    raw = raw_triples(spark, sf_small)
    cfg = ExportConfig(export_matching=True, export_full=True, export_unique_predicates=True, domain="event")
    res = run_batch(spark, raw, cfg)
    lazy = {r["metric"]: r["value"] for r in run_counters(raw, "event", cfg.fraction).collect()}
    assert res.counters == lazy
    assert res.counters["initCount"] > res.counters["finalCount"] >= res.counters["domainCount"] >= res.counters["sample"]
    for key in ("sample", "matching", "full", "unique_predicates", "cleaned"):
        assert os.path.isdir(res.paths[key]), key
    assert res.tokens.columns[-2:] == ["tokenizedObj", "filtered_tokens"]
    m = res.metrics(spark)
    assert m.where("metric = 'seconds'").count() >= 4 and m.where("stage = 'counters'").count() == 4


def test_random_sample_mode(spark, sf_small):
    res = run_batch(spark, raw_triples(spark, sf_small), ExportConfig(sample_mode="random", seed=1))
    assert 0 < res.counters["sample"] <= res.counters["domainCount"]


def test_counters_are_additive(spark):
    from triplex.plans.batch import combine_metrics
    from triplex.schema import METRICS_SCHEMA

    rows = []
    for _ in range(300):
        rows += [("counters", "count1", 1.0), ("counters", "count2", -2.0), ("counters", "count3", 10.0)]
    parts = [spark.createDataFrame(rows[i:i + 90], METRICS_SCHEMA) for i in range(0, len(rows), 90)]
    got = {r["metric"]: r["value"] for r in combine_metrics(*parts).collect()}
    assert got == {"count1": 300.0, "count2": -600.0, "count3": 3000.0}


def test_command_line_run(spark, sf_small):
    from pyspark.sql import functions as F

    from triplex.__main__ import main
    from triplex.schema import TRIPLE_COLUMNS
    from triplex.session import scratch_path

    tsv = scratch_path(spark, "t-cli-tsv")
    tr = raw_triples(spark, sf_small).where(~F.concat_ws("", *TRIPLE_COLUMNS).rlike("[\t\r\n]"))
    tr.select(F.concat_ws("\t", *TRIPLE_COLUMNS, F.lit(".")).alias("v")).write.text(tsv)
    report = main(["--input", tsv, "--mode", "ntriples", "--domain", "event", "--unique-predicates"], spark=spark)
    assert report["counters"]["initCount"] == tr.count()
    assert report["counters"]["domainCount"] > 0 and os.path.isdir(report["paths"]["unique_predicates"])


def test_scratch_follows_configured_checkpoint_dir(spark, tmp_path_factory):
    from triplex.session import checkpoint_root, scratch_path

    # spark.checkpoint.dir is fixed when a session starts: emulate one that set it.
    shared = str(tmp_path_factory.mktemp("shared-ckpt"))
    conf = spark.conf
    real_get = conf.get

    def get(key, *default):
        return shared if key == "spark.checkpoint.dir" else real_get(key, *default)

    import pytest

    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(conf, "get", get)
        assert checkpoint_root(spark) == shared
        p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
        assert p1.startswith(shared + "/scratch/x-") and p1 != p2


def test_command_line_gzip_input(spark):
    import gzip

    from triplex.__main__ import main
    from triplex.session import scratch_path

    d = scratch_path(spark, "t-cli-gz")
    os.makedirs(d)
    fb = "http://rdf.freebase.com/ns/"
    lines = [f"<{fb}m.{i % 40}>\t<{fb}common.topic.alias>\t\"n{i % 90}\"@en\t." for i in range(600)]
    with gzip.open(os.path.join(d, "dump.tsv.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")
    report = main(["--input", os.path.join(d, "dump.tsv.gz"), "--mode", "ntriples"], spark=spark)
    assert report["counters"]["initCount"] == 600
    assert report["counters"]["finalCount"] == len(set(lines)) == report["counters"]["domainCount"]


def test_two_runs_with_one_config_stay_readable(spark):
    from triplex.plans.batch import ExportConfig, run_batch
    from triplex.schema import TRIPLE_SCHEMA

    cfg = ExportConfig()
    frames = [spark.createDataFrame([(f"<s{n}{i}>", "<p>", "<o>") for i in range(n + 1)], TRIPLE_SCHEMA) for n in range(2)]
    first, second = (run_batch(spark, f, cfg) for f in frames)
    assert cfg.work_dir is None
    assert (first.cleaned.count(), second.cleaned.count()) == (1, 2)


def test_counters_deal_no_row_by_its_predicate_or_text(spark):
    import re

    from helpers import triples_df

    long = "x" * 500
    rows = [(f"m.{i}", "d.p", f"{long}{i % 7}") for i in range(700)] + [
        ("m.0", "d.p", f"{long}0"), ("m.0", "d.p", None), (None, "d.p", None), (None, "d.p", None), ("m.0", None, long),
        ("m.0", "e.q", f"{long}0"), ("", "d.p", ""), ("", "d.p", None), (long, "d.p", "m.0"), (long, "d.p", "m.0"),
    ]
    raw = triples_df(spark, rows)
    found = run_counters(raw, "d", 1.0)
    domain = {r for r in rows if r[1] == "d.p"}
    assert {r["metric"]: r["value"] for r in found.collect()} == {
        "initCount": len(rows), "finalCount": len(set(rows)), "domainCount": len(domain), "sample": len(domain),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*Object#", plan)  # texts are no keys
    join = plan[plan.index("Join"):]
    assert join.index("_p#") < join.index("HashAggregate")  # counts are joined, not rows
    assert dict((r["metric"], r["value"]) for r in run_counters(raw.limit(0), "d", 1.0).collect()) == {
        "initCount": None, "finalCount": 0, "domainCount": 0, "sample": 0,
    }


def test_duplicate_counts_by_bounded_keys(spark):
    from helpers import triples_df

    from triplex.operators.triples import KEY_CHARS, bounded_key, duplicate_counts

    values = [None, "", "#", "=", "é" * KEY_CHARS, "é" * (KEY_CHARS + 1), "x" * 5000, "x" * 5001]
    rows = [(a, "p", b) for a in values for b in values]
    raw = triples_df(spark, rows + rows[::3])
    n = len(rows) + len(rows[::3])
    assert [tuple(r) for r in duplicate_counts(raw).collect()] == [(n, len(rows), n - len(rows))]
    assert max(len(r[0] or "") for r in raw.select(bounded_key("Object")).collect()) == KEY_CHARS + 1
