"""Golden rows for the cleaning rules (subject, predicate, object, parts)."""

import pytest
from helpers import one_col
from pyspark.sql import functions as F

from triplex.functions import clean as C

FB = "http://rdf.freebase.com/ns/"

PREDICATES = [
    (f"<{FB}type.object.name>", "type.object.name"),
    (f"<{FB}common.notable_for.display_name>", "common.notable_for.display_name"),
    ("<http://www.w3.org/2000/01/rdf-schema#label>", "type.object.name"),
    (f"<{FB}common.topic.alias>", "common.topic.alias"),
    (f"<{FB}common.topic.description>", "common.topic.description"),
    ("<a>", "<a>"),
    ("<http://x/y/>", ""),
    ("rdf-schema#label", "type.object.name"),
    ("<http://www.w3.org/1999/02/rdf-syntax-ns#type>", "type.object.type"),
    ("<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>", "22-rdf-syntax-ns#type"),
    ("plain.value", "plain.value"),
    (None, None),
]

SUBJECTS = [
    (f"<{FB}american_football.football_player.footballdb_id>", "american_football.football_player.footballdb_id"),
    (f"<{FB}astronomy.astronomical_observatory.discoveries>", "astronomy.astronomical_observatory.discoveries"),
    (f"<{FB}biology.organism_classification.child_classifications>",
     "biology.organism_classification.child_classifications"),
    ("<http://x.org/q>", "<http://x.org/q"),
    ("m.9>", "m.9"),
    (f"<{FB}", ""),
    (f"<{FB}>", ""),
    ("m.9", "m.9"),
    (None, None),
]

OBJECTS = [
    ('"Foo bar"@en', '"Foo bar"'),
    ('"12"^^<http://www.w3.org/2001/XMLSchema#int>', ""),
    (f"<{FB}m.1>", ""),
    ('"mail a@b.c"@en', '"mail a'),
    ("a\nb@c", ""),
    ("@", ""),
    (None, None),
]


def _apply(spark, fn, cases):
    df = one_col(spark, "x", [c[0] for c in cases])
    got = [r[0] for r in df.select(fn("x")).collect()]
    return got, [c[1] for c in cases]


def test_clean_predicate_golden(spark):
    got, want = _apply(spark, C.clean_predicate, PREDICATES)
    assert got == want


def test_clean_subject_golden(spark):
    got, want = _apply(spark, C.clean_subject, SUBJECTS)
    assert got == want


def test_object_unquote_then_text(spark):
    # \"quoted\"@en: the unquote pattern needs \" at both ends, so nothing is
    # unquoted here; the text before "@" is kept.
    df = one_col(spark, "x", ['\\"quoted\\"@en', '\\"whole\\"'])
    got = [r[0] for r in df.select(C.unquote_object("x")).collect()]
    assert got == ['\\"quoted\\"@en', "whole"]


@pytest.mark.parametrize("raw,want", OBJECTS)
def test_clean_object_golden(spark, raw, want):
    df = one_col(spark, "x", [raw])
    assert df.select(C.clean_object("x")).first()[0] == want


def test_object_parts(spark):
    df = one_col(spark, "x", [
        '"Foo"@en-GB', '"12"^^<http://www.w3.org/2001/XMLSchema#int>', f"<{FB}m.1>", "<http://x/y>",
        '"multi\nline"@fr', "bare", None,
    ])
    rows = df.select(C.object_id("x"), C.object_lang("x"), C.object_datatype("x")).collect()
    assert [tuple(r) for r in rows] == [
        (None, "en-GB", None),
        (None, None, "http://www.w3.org/2001/XMLSchema#int"),
        ("m.1", None, None),
        ("<http://x/y", None, None),
        (None, "fr", None),
        (None, None, None),
        (None, None, None),
    ]


def test_domain_and_parts(spark):
    df = one_col(spark, "p", ["a.b.c", "a", "", "a..b", "a.", ".x"])
    rows = df.select(C.domain_of("p"), F.array_join(C.path_parts("p"), "|")).collect()
    assert [tuple(r) for r in rows] == [
        ("a", "a|b|c"), ("a", "a"), ("", ""), ("a", "a||b"), ("a", "a|"), ("", "|x"),
    ]


def test_no_python_udf_in_cleaning_plan(spark):
    from triplex.operators.triples import clean_triples
    from helpers import triples_df

    df = clean_triples(triples_df(spark, [("<a>", "<b/c>", '"d"@en')]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_rules_without_a_pattern_equal_the_patterns(spark):
    import itertools

    from pyspark.sql import functions as F

    from triplex import constants
    from triplex.functions import clean

    pieces = ["", "<", "/", ">", "@", '"', "a", "\n", "\r", "\u2028", "\U0001f600"]
    values = {"".join(x) for x in itertools.product(pieces, repeat=4)} | {None, '"a"@en', '"a"@e@n', '"a"^^<b>', '"a"^^<b>\n', '"@en', '"@"@en'}
    df, c = spark.createDataFrame([(x,) for x in values], "c string"), F.col("c")
    quoted = c.startswith('"')
    pairs = [
        (clean.predicate_tail(c), F.regexp_replace(c, constants.PREDICATE_TAIL_REGEX, "$1")),
        (clean.object_text(c), F.regexp_extract(c, constants.OBJECT_TEXT_REGEX, 1)),
        (clean.object_lang(c), F.when(quoted, clean._nonempty(F.regexp_extract(c, clean.LANG_REGEX, 1)))),
        (clean.object_datatype(c), F.when(quoted, clean._nonempty(F.regexp_extract(c, clean.DATATYPE_REGEX, 1)))),
    ]
    for own, by_pattern in pairs:
        assert df.where(~own.eqNullSafe(by_pattern)).select("c").collect() == []
        assert df.where(own.isNotNull() & ~own.eqNullSafe(c)).count() > 0
    plan = df.select(clean.object_text(c))._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan
