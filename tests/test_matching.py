"""Matching operators against their literal subjects x objects definition."""

import pytest
from helpers import triples_df
from pyspark.sql import functions as F

from triplex.operators import matching
from triplex.operators.triples import object_parts


def literal_matching(cl, leaves):
    """The product form: distinct subjects x distinct objects, contains, join back."""
    subjects = cl.select("Subject").distinct()
    objects = cl.select("Object").distinct()
    pairs = subjects.crossJoin(objects).where(F.col("Object").contains(F.col("Subject")))
    dom = cl.where(F.col("Predicate").isin(leaves))
    return dom.join(pairs, ["Subject", "Object"], "inner").select("Subject", "Object", "Predicate")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FIXTURE = [
    ("a", "d.p", "xay"), ("a", "d.p", "xay"), ("b", "d.p", "a"), ("c", "d.q.r", "c"),
    ("d", "d.p", None), ("", "d.p", "z"), ("c", "d.q", "c"),
]


def test_matching_equals_product_form(spark):
    cl = triples_df(spark, FIXTURE)
    got = rows(matching.matching_triples(cl, "d"))
    # leaves of domain d: d.p and d.q.r (d.q has a child)
    assert got == rows(literal_matching(cl, ["d.p", "d.q.r"]))
    assert got == [("", "z", "d.p"), ("a", "xay", "d.p"), ("a", "xay", "d.p"), ("c", "c", "d.q.r")]


SUBSTRING_FIXTURE = [
    ("m.u1", "p", "click of m.u12"), ("m.u12", "p", "x"), ("a.b*", "p", "see a.b* and m.u1"),
    ("\\E", "p", "tail\\E"), ("Été", "p", "ÉtÉté Été"), ("q", "p", "qq"), ("long.subject.name", "p", "short"),
    ("", "p", "anything"), (None, "p", "m.u1"),
]


def brute_pairs(cl):
    s = cl.select("Subject").where(F.col("Subject").isNotNull()).distinct()
    o = cl.select("Object").where(F.col("Object").isNotNull()).distinct()
    return s.crossJoin(o).where(F.col("Object").contains(F.col("Subject")))


@pytest.mark.parametrize("heavy", [10**6, 1])
def test_substring_pairs_exact(spark, heavy):
    cl = triples_df(spark, SUBSTRING_FIXTURE)
    got = rows(matching.substring_pairs(cl, heavy))
    assert got == rows(brute_pairs(cl))
    assert ("m.u1", "click of m.u12") in got and ("", "anything") in got


def test_grams_of_every_place(spark):
    texts = ["ab", "abcabc", "é日\U0001f600x" * 9, "y"]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "_id long, _text string, _size int")
    for k in (1, 2, 3):
        want = sorted((i, t[p : p + k], p) for i, t in enumerate(texts) for p in range(len(t) - k + 1))
        for chunks in (matching.CHUNKS, (7, 3, 2), (1,), (5,)):
            got = matching.text_grams(df, k, chunks=chunks).select("_id", "_gram", "_place")
            assert sorted(map(tuple, got.collect())) == want
    assert matching.text_grams(df, 2, F.lit(False)).count() == 0


def test_the_rarest_gram_is_chosen_without_a_sort(spark):
    texts = ["abcd", "xabc", "zz", "", "bcdé", "😀abc"]
    subjects = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "_id long, _text string, _size int")
    uses = {"abc": 9, "bcd": 3, "xab": 4, "zz": 5, "cdé": 2, "😀ab": 1}
    found = matching.rarest_grams(subjects, spark.createDataFrame(list(uses.items()), "_gram string, _uses long"))
    got = sorted(tuple(r) for r in found.select("_id", "_gram", "_place", "_uses").collect())
    assert got == [(0, "bcd", 1, 3), (1, "xab", 0, 4), (2, "zz", 0, 5), (4, "cdé", 1, 2), (5, "😀ab", 0, 1)]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_substring_pairs_with_thousands_of_subject_lengths(spark):
    n = 5000
    long = "xy" * n
    cl = triples_df(spark, [("x" + "z" * i, "p", "") for i in range(n)] + [("s", "p", "a" + "x" + "z" * 4600 + "b"), ("t", "p", long)])
    got = {(r["Subject"], r["Object"]) for r in matching.substring_pairs(cl).collect()}
    big = "a" + "x" + "z" * 4600 + "b"
    assert {s for s, o in got if o == big} == {"x" + "z" * i for i in range(4601)}
    assert {s for s, o in got if o == long} == {"x"}


def test_substring_pairs_lists_nothing_on_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*a, **k):
        raise AssertionError("rows listed on the driver")

    cl = triples_df(spark, SUBSTRING_FIXTURE)
    for name in ("collect", "toPandas", "take", "head", "first"):
        monkeypatch.setattr(DataFrame, name, refuse)
    matching.substring_pairs(cl)


def test_substring_pairs_no_product_in_plan(spark):
    cl = triples_df(spark, SUBSTRING_FIXTURE)
    plan = matching.substring_pairs(cl)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_id_mentions_whole_ids(spark):
    cl = triples_df(spark, SUBSTRING_FIXTURE)
    got = rows(matching.id_mentions(cl))
    assert ("m.u12", "click of m.u12") in got
    assert ("m.u1", "click of m.u12") not in got
    assert ("m.u1", "see a.b* and m.u1") in got


def test_id_mentions_any_subject(spark):
    subjects = ["m.9", "m.9.q", "g.11b", "<http://x.org/s/1", "q", "", "..", "two words"]
    texts = ["m.9.q is", "see (m.9).", "g.11b: m.9, m.9", "at <http://x.org/s/1>, q!", "aq two words ..", None]
    cl = triples_df(spark, [(s, "p", t) for s, t in zip([*subjects], [*texts, "", "q"])])
    assert rows(matching.id_mentions(cl)) == sorted([
        ("m.9.q", "m.9.q is"), ("m.9", "see (m.9)."), ("g.11b", "g.11b: m.9, m.9"), ("m.9", "g.11b: m.9, m.9"),
        ("<http://x.org/s/1", "at <http://x.org/s/1>, q!"), ("q", "at <http://x.org/s/1>, q!"), ("q", "q"),
    ], key=repr)


def test_id_mentions_beside_any_punctuation(spark):
    import re

    subjects = ["m.9", "m.1", "m.2", "m.9.q", "m.9-x", "g.11b", "<http://x.org/ns/m.9"]
    texts = ["ns/m.9", "m.1|m.2", "id=m.9", "see:m.9", "m.9*", "m.9-x", "m.9.q#", "xm.9 m.99 .m.1 m.2_", "<http://x.org/ns/m.9>", "~g.11b... m.2.", "é" + "m.1" + "é"]
    cl = triples_df(spark, [(s, "p", "") for s in subjects] + [(None, "p", t) for t in texts])
    # Its own boundary: no letter, digit, _ or dot on either side, but for dots that end the mention.
    want = {
        (s, t) for s in subjects for t in texts if re.search(rf"(?<![\w.]){re.escape(s)}(?!\.*\w)", t, re.A)
    }
    assert ("m.9", "ns/m.9") in want and ("m.2", "m.1|m.2") in want and ("m.1", "xm.9 m.99 .m.1 m.2_") not in want
    assert {tuple(r) for r in matching.id_mentions(cl).collect()} == want


def test_subject_as_object(spark):
    raw = triples_df(spark, [
        ("<http://rdf.freebase.com/ns/m.1>", "<http://rdf.freebase.com/ns/a.b>", "<http://rdf.freebase.com/ns/m.2>"),
        ("<http://rdf.freebase.com/ns/m.2>", "<http://rdf.freebase.com/ns/a.c>", '"x"@en'),
        ("<http://rdf.freebase.com/ns/m.3>", "<http://rdf.freebase.com/ns/a.c>", '"y"@en'),
    ])
    got = rows(matching.subject_as_object(object_parts(raw)))
    assert got == [("m.2", "a.c", '"x"')]


def test_raw_first_id_joins_equal_parts_forms(spark):
    from triplex.operators.graph import graph_edges, graph_edges_from_raw
    from triplex.operators.triples import drop_duplicate_triples

    fb = "http://rdf.freebase.com/ns/"
    raw = triples_df(spark, [
        (f"<{fb}m.1>", f"<{fb}a.b>", f"<{fb}m.2>"),
        (f"<{fb}m.1>", f"<{fb}a.b>", f"<{fb}m.2>"),      # duplicate
        ("m.1>", f"<{fb}a.b>", f"<{fb}m.2>"),            # cleans to the same triple
        (f"<{fb}m.2>", f"<{fb}a.c>", '"x"@en'),
        (f"<{fb}m.2>", f"<{fb}a.d>", f"<{fb}m.9>"),      # m.9 is not a subject
        (f"<{fb}m.3>", f"<{fb}a.c>", '"y"@en'),
        (None, f"<{fb}a.c>", f"<{fb}m.1>"),
    ])
    parts = object_parts(drop_duplicate_triples(raw))
    for heavy in (1, 10**6):
        assert rows(matching.subject_as_object_from_raw(raw, heavy)) == rows(matching.subject_as_object(parts, heavy))
        assert rows(graph_edges_from_raw(raw, heavy)) == rows(graph_edges(parts, heavy))


def test_copies_are_combined_before_the_join(spark):
    fb = "http://rdf.freebase.com/ns/"
    one = triples_df(spark, [(f"<{fb}m.1>", f"<{fb}a.b>", f"<{fb}m.1>")])
    raw = one.join(spark.range(0, 200000, 1, 4), how="cross").drop("id")
    assert rows(matching.subject_as_object_from_raw(raw)) == [("m.1", "a.b", "")]
    plan = matching.subject_as_object_from_raw(raw)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "Aggregate [Subject" in plan[join:] and "Aggregate" not in plan[:join]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_piece = st.lists(st.sampled_from(["a", "b", ".", "*", "(", "\\", "E", "Q", "é", " "]), min_size=0, max_size=5).map("".join)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_piece, _piece), min_size=1, max_size=12), st.sampled_from([10**6, 2]))
def test_substring_pairs_property(spark, pairs, heavy):
    cl = triples_df(spark, [(s, "p", o) for s, o in pairs])
    assert rows(matching.substring_pairs(cl, heavy)) == rows(brute_pairs(cl))
