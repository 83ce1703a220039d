"""Predicate hierarchy: leaves, nodes and sizes against a set-based model."""

import pytest
from helpers import one_col, triples_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from triplex.operators.hierarchy import (
    domain_leaves,
    hierarchy_sizes,
    leaf_predicates,
    predicate_hierarchy,
)


def model_domain_leaves(predicates, domain):
    """Leaves by definition: predicates of the domain, below the domain node,
    that no other predicate extends with a further dotted part."""
    preds = set(predicates)
    return sorted(
        p for p in preds
        if p.startswith(domain + ".")
        and not any(q != p and q.startswith(p + ".") for q in preds)
    )


def _cl(spark, preds):
    return triples_df(spark, [("s", p, "o") for p in preds])


def test_fixture_dotted_leaves(spark):
    preds = ["a.b", "a.b.c", "a.d", "z", "a.b-x"]
    got = sorted(r[0] for r in domain_leaves(_cl(spark, preds), "a").collect())
    assert got == ["a.b-x", "a.b.c", "a.d"]
    assert sorted(r[0] for r in leaf_predicates(_cl(spark, preds)).collect()) == ["a.b-x", "a.b.c", "a.d", "z"]


def test_domain_without_dotted_predicates(spark):
    assert domain_leaves(_cl(spark, ["z", "a.b"]), "z").count() == 0


def test_unknown_domain(spark):
    cl = _cl(spark, ["a.b"])
    assert domain_leaves(cl, "nope").count() == 0
    with pytest.raises(KeyError):
        domain_leaves(cl, "nope", strict=True)


def test_nodes_and_flags(spark):
    rows = predicate_hierarchy(_cl(spark, ["a.b", "a.b.c", "a..x", "q"])).collect()
    got = {r["path"]: (r["parent"], r["part"], r["depth"], r["is_leaf"]) for r in rows}
    assert got == {
        "a": (None, "a", 1, False),
        "a.b": ("a", "b", 2, False),
        "a.b.c": ("a.b", "c", 3, True),
        "a.": ("a", "", 2, False),
        "a..x": ("a.", "x", 3, True),
        "q": (None, "q", 1, True),
    }


def test_sizes(spark):
    cl = triples_df(spark, [("s", "a.b", "o"), ("t", "a.b", "o"), ("s", "a.c", "o"), ("s", None, "o")])
    got = {r["path"]: (r["n_predicates"], r["n_triples"]) for r in hierarchy_sizes(cl).collect()}
    assert got == {"a": (2, 3), "a.b": (1, 2), "a.c": (1, 1)}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", ""]), min_size=1, max_size=4).map(".".join),
                min_size=1, max_size=12))
def test_leaves_match_template_model(spark, preds):
    preds = [p for p in preds if p.split(".")[0] != ""]  # the empty domain is a documented deviation
    if not preds:
        return
    cl = _cl(spark, preds)
    for domain in {p.split(".")[0] for p in preds}:
        got = sorted(r[0] for r in domain_leaves(cl, domain).collect())
        assert got == model_domain_leaves(preds, domain), (preds, domain)


def test_null_predicates_ignored(spark):
    df = one_col(spark, "Predicate", [None, "a.b"])
    assert [r[0] for r in leaf_predicates(df).collect()] == ["a.b"]


def test_empty_named_domain_keeps_original_predicates(spark):
    cl = _cl(spark, [".x", ".y.z", ".y", "a.b"])
    assert sorted(r[0] for r in domain_leaves(cl, "").collect()) == [".x", ".y.z"]
