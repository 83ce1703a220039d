"""Stages that return their input's columns: extra columns keep their values, whatever their names."""

import pytest

from triplex.llm import exact_dedup, language_id, ownership, simhash

NAMES = (
    "key_id key_digest digest DIGEST_ of_digest steps last again n kept kept_row row_id _row_id _steps _last _text_digest "
    "_keep_id fp first first_id no_id root node start from end before live value doc_id_ h cut"
).split()
BASE = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "one two three", "en", "a", 13), (2, "one two three", "en", "b", 13), (None, "one two three", "en", "b", 13),
    (4, "é token=mine4711x and more", "en", "a", 26), (5, None, None, None, None), (5, None, None, None, None),
    (6, "x" * 300_000, "en", "c", 300_000), (2**53 + 1, "another text", "en", "c", 12),
]
STAGES = {
    "exact_dedup": exact_dedup.drop_copies,
    "simhash": simhash.drop_near_copies,
    "secrets": ownership.redact,
    "language": lambda d: language_id.keep_known(d, language_id.fit(d)),
}


def extra(i):
    return tuple(f"{name} {i}" for name in NAMES)


@pytest.mark.parametrize("name", STAGES)
def test_extra_columns_keep_their_values(spark, name):
    rows = [(*r, *extra(i)) for i, r in enumerate(ROWS)]
    schema = BASE + "".join(f", `{c}` string" for c in NAMES)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    plain = STAGES[name](spark.createDataFrame(ROWS, BASE).repartition(3))
    out = STAGES[name](docs)
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    for r in got:
        i = int(r[-1].split()[-1])
        assert r[5:] == extra(i) and (r[0], *r[2:4]) == (ROWS[i][0], *ROWS[i][2:4])
        assert r[1] == ROWS[i][1] or (name == "secrets" and i == 3 and r[1] == "é [SECRET] and more" and r[4] == 19)
    assert len({r[-1] for r in got}) == len(got)
    same = lambda rs: sorted(repr(tuple(r)[:5]) for r in rs)
    assert same(got) == same(plain.collect())
