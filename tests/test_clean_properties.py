"""Property tests: the native cleaning expressions against the rules written as string logic."""

from helpers import one_col
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from triplex.constants import PREDICATE_MAPPING, SUBJECT_PREFIX
from triplex.functions.clean import clean_predicate, clean_subject

MAPPING = dict(PREDICATE_MAPPING)


def rule_predicate(s):
    """Tail after the last '/' of a '<...>' value whose body has no newline.

    A single trailing newline may follow the closing '>' and is kept.
    """
    if s is None:
        return None
    core, tail = (s[:-1], "\n") if s.endswith("\n") else (s, "")
    out = s
    if len(core) >= 3 and core[0] == "<" and core[-1] == ">" and "\n" not in core and "/" in core[1:-1]:
        out = core[core.rindex("/", 1, len(core) - 1) + 1:-1] + tail
    return MAPPING.get(out, out)


def rule_subject(s):
    if s is None:
        return None
    if s.startswith(SUBJECT_PREFIX):
        s = s[len(SUBJECT_PREFIX):]
    return s[:-1] if s.endswith(">") else s


ALPHABET = ["<", ">", "/", "a", ".", "#", "\n", "\r", "é"]
texts = st.lists(st.sampled_from(ALPHABET), max_size=8).map("".join)
predicates = st.one_of(
    texts,
    st.builds(lambda a, b: f"<{a}/{b}>", texts, texts),
    st.builds(lambda a: f"<http://x/{a}>\n", texts),
    st.sampled_from(["rdf-schema#label", "<http://w3/rdf-syntax-ns#type>", "<a/rdf-schema#label>\n"]),
)
subjects = st.one_of(texts, st.builds(lambda a: SUBJECT_PREFIX + a, texts), st.builds(lambda a: a + ">", texts))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(predicates, min_size=1, max_size=60))
def test_predicate_rule(spark, values):
    got = [r[0] for r in one_col(spark, "p", values).select(clean_predicate("p")).collect()]
    assert got == [rule_predicate(v) for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(subjects, min_size=1, max_size=60))
def test_subject_rule(spark, values):
    got = [r[0] for r in one_col(spark, "s", values).select(clean_subject("s")).collect()]
    assert got == [rule_subject(v) for v in values]
