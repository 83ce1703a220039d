"""Domain filter, hash and random samples, positions, counts."""

from helpers import triples_df

from triplex.operators import domains
from triplex.operators.triples import clean_triples, drop_duplicate_triples, duplicate_counts, triple_multiplicity
from triplex.operators.vocabulary import domain_counts, keyword_predicates, ordered_positions, top_domains

FB = "http://rdf.freebase.com/ns/"


def _raw(spark, n=400):
    rows = []
    for i in range(n):
        rows.append((f"<{FB}m.{i}>", f"<{FB}d.p{i % 3}>", f'"v{i}"@en'))
        rows.append((f"<{FB}m.{i}>", f"<{FB}e.q>", f"<{FB}m.{i + 1}>"))
    rows.append(rows[0])
    return triples_df(spark, rows)


def test_domain_filter_equals_a_literal_list(spark, monkeypatch):
    cl = clean_triples(drop_duplicate_triples(_raw(spark)))
    want = sorted(map(tuple, cl.where("Predicate IN ('d.p0', 'd.p1', 'd.p2')").collect()))
    assert sorted(map(tuple, domains.domain_triples(cl, "d").collect())) == want and len(want) == 400
    monkeypatch.setattr(domains, "BITMAP_BITS", 64)  # many false hits: the join settles them
    assert sorted(map(tuple, domains.domain_triples(cl, "d").collect())) == want
    assert domains.domain_triples(cl, "unknown").count() == 0


def test_a_hot_predicate_is_split(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(domains, "HOT_ROWS", 100, raising=False)
    rows = triples_df(spark, [(f"m.{i}", "d.p", "v") for i in range(2000)] + [("s", "d.q", "v"), ("s", None, "v")]).repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # each task is one partition
    try:
        found = domains.filter_to_predicates(rows, rows.select("Predicate").where("Predicate = 'd.p'"))
        per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 2000 and max(per_task) < 1500


def test_a_given_vocabulary_decides(spark):
    from triplex.operators.hierarchy import predicate_hierarchy

    raw = _raw(spark)
    cl = clean_triples(drop_duplicate_triples(raw))
    own = predicate_hierarchy(cl)
    given = spark.createDataFrame([
        ("d", None, "d", 1, False), ("d.p1", "d", "p1", 2, True), ("d.p2", "d", "p2", 2, False),
        ("d.p2.x", "d.p2", "x", 3, True), ("e.q", "e", "q", 2, True), ("d", None, "d", 1, True),
    ], own.schema)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(domains.domain_triples(cl, "d", hierarchy=own)) == rows(domains.domain_triples(cl, "d"))
    want = rows(cl.where("Predicate = 'd.p1'"))  # p0 is not in it, p2 no leaf there
    assert rows(domains.domain_triples(cl, "d", hierarchy=given)) == want
    assert rows(domains.domain_triples_from_raw(raw, "d", given)) == want


def test_building_a_domain_query_runs_no_job(spark):
    raw = _raw(spark)
    cl = clean_triples(drop_duplicate_triples(raw))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    domains.domain_triples(cl, "d")
    domains.domain_triples_from_raw(raw, "d")
    domains.domain_sample_hash(drop_duplicate_triples(raw), "d", 0.5)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_hash_sample_is_subset_and_repeatable(spark):
    dedup = drop_duplicate_triples(_raw(spark))
    a = sorted(map(tuple, domains.domain_sample_hash(dedup, "d", 0.3).collect()))
    b = sorted(map(tuple, domains.domain_sample_hash(dedup.repartition(7), "d", 0.3).collect()))
    dom = set(map(tuple, domains.domain_triples(clean_triples(dedup), "d").collect()))
    assert a == b and set(a) <= dom and 60 < len(a) < 180
    assert domains.domain_sample_hash(dedup, "d", 0.0).count() == 0
    assert domains.domain_sample_hash(dedup, "d", 1.0).count() == 400


def test_random_sample_subset(spark):
    cl = clean_triples(drop_duplicate_triples(_raw(spark)))
    s = set(map(tuple, domains.domain_sample_random(cl, "d", 0.5, seed=3).collect()))
    assert s <= set(map(tuple, domains.domain_triples(cl, "d").collect()))


def test_counts(spark):
    raw = _raw(spark)
    r = duplicate_counts(raw).first()
    assert (r.raw_count, r.dedup_count, r.duplicate_count) == (801, 800, 1)
    assert triple_multiplicity(raw).first()["n"] == 2


def test_domain_counts_and_top(spark):
    cl = clean_triples(drop_duplicate_triples(_raw(spark)))
    got = {r["domain"]: (r["n_predicates"], r["n_triples"]) for r in domain_counts(cl).collect()}
    assert got == {"d": (3, 400), "e": (1, 400)}
    assert [r["domain"] for r in top_domains(cl, 1).collect()] == ["d"]


def test_keyword_hits_keep_duplicates(spark):
    vocab = spark.createDataFrame([("a.person.topic",), ("b.order",)], "Predicate string")
    got = [tuple(r) for r in keyword_predicates(vocab, ["person", "topic", "zzz"]).collect()]
    assert got == [("a.person.topic", "person"), ("a.person.topic", "topic")]


def test_ordered_positions_distributed(spark):
    import random

    vals = [f"p{random.Random(1).random():.6f}{i}" for i in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "Predicate string").repartition(5)
    got = {r[0]: r[1] for r in ordered_positions(df, "Predicate").collect()}
    want = {v: i for i, v in enumerate(sorted(v for v in set(vals) if v is not None))}
    assert got == want


def test_raw_first_domain_path_equals_cleaned_path(spark):
    raw = triples_df(spark, [
        ("<http://a/m.1>", "<http://a/d.x.y>", '"one"@en'),
        ("<http://a/m.1>", "<http://b/d.x.y>", '"one"@en'),   # same cleaned predicate
        ("<http://a/m.2>", "d.x.y", '"two"@en'),              # already clean
        ("<http://a/m.3>", "<http://a/d.x>", '"parent"@en'),  # d.x is not a leaf
        ("<http://a/m.4>", "<http://a/e.z>", '"other"@en'),
        ("<http://a/m.4>", None, '"none"@en'),
        ("<http://a/m.1>", "<http://a/d.x.y>", '"one"@en'),   # exact duplicate
    ])
    want = sorted(map(tuple, domains.domain_triples(clean_triples(drop_duplicate_triples(raw)), "d").collect()))
    got = sorted(map(tuple, domains.domain_triples_from_raw(raw, "d").collect()))
    assert got == want and len(got) == 3  # cleaning re-creates one duplicate


def test_raw_first_filter_has_no_regex(spark):
    raw = _raw(spark)
    plan = domains.domain_triples_from_raw(raw, "d")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    filters = [line for line in plan if "Filter" in line]
    assert any("scalar-subquery" in line for line in filters) and all("regexp" not in line for line in filters)


def test_edge_cases(spark):
    from triplex.operators.hierarchy import leaf_predicates, predicate_hierarchy
    from triplex.operators.matching import id_mentions, substring_pairs

    vocab = spark.createDataFrame([("a.b",)], "Predicate string")
    assert keyword_predicates(vocab, []).count() == 0
    no_subjects = triples_df(spark, [(None, "p", "text"), (None, "q", None)])
    assert substring_pairs(no_subjects).count() == 0
    assert id_mentions(no_subjects).count() == 0
    null_preds = triples_df(spark, [("s", None, "o")])
    assert predicate_hierarchy(null_preds).count() == 0 and leaf_predicates(null_preds).count() == 0
    assert domain_counts(null_preds).collect()[0]["n_predicates"] == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_path = st.lists(st.sampled_from(["d", "e", "x", ""]), min_size=1, max_size=4).map(".".join)
_raw_pred = st.one_of(
    _path,
    st.builds(lambda p: f"<http://a/{p}>", _path),
    st.builds(lambda p: f"<http://b/c/{p}>", _path),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["<s1>", "<s2>"]), _raw_pred), min_size=1, max_size=10),
       st.sampled_from(["d", "e", "x"]))
def test_raw_first_domain_property(spark, rows, domain):
    raw = triples_df(spark, [(s, p, '"o"@en') for s, p in rows])
    want = sorted(map(tuple, domains.domain_triples(clean_triples(drop_duplicate_triples(raw)), domain).collect()))
    got = sorted(map(tuple, domains.domain_triples_from_raw(raw, domain).collect()))
    assert got == want
