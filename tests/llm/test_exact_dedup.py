import hashlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from triplex.llm.exact_dedup import _misra_gries, drop_copies, exact_dedup, heavy_digests, text_digests


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return sorted(
        (i, max(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows
    )


ROWS = [(1, "a b"), (2, "a b"), (3, "A b"), (4, None), (5, ""), (6, " "), (7, "x" * 300_000), (8, "x" * 300_000),
        (9, "ä\x00z"), (10, "ä\x00z"), *[(100 + i, "hot") for i in range(400)], *[(600 + i, f"t{i % 90}") for i in range(200)]]


@pytest.mark.parametrize("share", [1 / 1024, 1 / 8, 1.0])
def test_against_brute_force_at_every_split(make_docs, share):
    got = exact_dedup(make_docs(ROWS), share=share).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got) == brute(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_empty_table(make_docs):
    assert exact_dedup(make_docs([])).count() == 0


def test_repeated_rows_keep_exactly_one(make_docs):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "a"), (None, None)]
    got = exact_dedup(make_docs(rows)).collect()
    assert len(got) == len(rows)
    assert Counter((r.keep_id, r.group_size) for r in got if r.kept) == Counter({(1, 4): 1, (2, 1): 2, (None, 1): 1})
    left = drop_copies(make_docs(rows))
    assert sorted((r.doc_id, r.text) for r in left.where("doc_id is not null").collect()) == [(1, "a"), (2, "b"), (2, "c")]
    assert left.columns == make_docs(rows).columns


def test_misra_gries_finds_every_heavy_digest():
    stream = [b"h1", b"h2", b"h1"] * 40 + [bytes([i]) for i in range(200)]
    got = next(_misra_gries(8)(pd.DataFrame({"digest": stream[i : i + 7]}) for i in range(0, len(stream), 7)))
    bound = dict(zip(got["digest"], got["at_least"]))
    assert len(bound) <= 8 and {b"h1", b"h2"} <= set(bound)
    assert 80 - len(stream) / 9 <= bound[b"h1"] <= 80


def test_heavy_digests_are_bounded_and_exact(make_docs):
    heavy = heavy_digests(text_digests(make_docs(ROWS)), share=0.25).collect()
    assert [(r.keep.doc_id, r.n) for r in heavy] == [(499, 400)]
