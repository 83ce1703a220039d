import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from triplex.llm import merkle

#: Extra columns with names that the operator uses itself.
ROWS = StructType([
    StructField("doc_id", LongType()), StructField("source", StringType()), StructField("lang", StringType()),
    StructField("n_chars", IntegerType()), StructField("text", StringType()), StructField("tree", StringType()),
    StructField("digest", StringType()), StructField("lo", StringType()), StructField("key", StringType()),
    StructField("row", StringType()), StructField("payload", StringType()), StructField("path", StringType()),
])


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def steps(lv, i):
    found = []
    for nodes in lv[:-1]:
        a = i // 8 * 8
        found.append((nodes[a:i], nodes[i + 1 : a + 8]))
        i //= 8
    return found


def brute(rows, changed):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for t in names:
        trees[t].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    all_levels = [levels([leaf(r) for r in trees[t]]) for t in names]
    top = levels([lv[-1][0] for lv in all_levels])
    out = []
    for q, t in enumerate(names):
        for i, r in enumerate(trees[t]):
            path = steps(all_levels[q], i) + steps(top, q)
            node = leaf(changed(r))
            for a, b in path:
                node = H(*a, node, *b)
            proof = H(*(h for a, b in path for h in a + b))
            out.append((r[0], leaf(r), all_levels[q][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "d", "0", "k", "r", "p", None) for r in rows], ROWS).repartition(3)


def audit(spark, rows, every=3):
    bad = F.col("doc_id") % every == 0
    found = merkle.audit(frame(spark, rows), {"text": F.lower("text")}, bad).collect()
    return sorted((tuple(r) for r in found), key=repr)


def lowered(every=3):
    return lambda r: (*r[:4], r[4].lower()) if r[0] is not None and r[0] % every == 0 and r[4] is not None else r


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 7, 64, 513], [2] * 20])
def test_matches_brute_force(spark, sizes):
    rng = random.Random(sum(sizes))
    rows, n = [], 0
    for t, size in enumerate(sizes):
        for _ in range(size):
            n += rng.randint(1, 3)
            rows.append((n, f"s{n % 4}", f"l{t}", n, "Ab c" * rng.randint(0, 4)))
    rng.shuffle(rows)
    assert audit(spark, rows) == brute(rows, lowered())


def test_nulls_ties_repeated_and_long_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "s", None, 1, ""), (5, "s", None, 1, "A"), (5, "s", None, 1, "B"),
        (5, "s", None, 1, "B"), (7, "", "", 0, "é-ø 語"), (9, "s", "de", None, "X" * 2_000_000), (2**53 + 1, "s", "de", 3, "y"),
    ]
    assert audit(spark, rows) == brute(rows, lowered())


def test_only_changed_text_fails_and_root_sees_every_row(spark):
    rows = [(i, "s", f"l{i % 3}", 1, "Abc" if i % 2 else "abc") for i in range(100)]
    found = audit(spark, rows)
    assert {r[0] for r in found if not r[-1]} == {i for i in range(100) if i % 3 == 0 and i % 2}
    roots = {merkle.manifest(frame(spark, x)).root().first()[0] for x in (rows, rows[:-1], rows[:50] + rows[51:])}
    assert len(roots) == 3


def test_labels_cover_every_leaf_once_on_each_level(spark):
    rows = [(i, "s", "a" if i < 70 else "b", 1, str(i)) for i in range(75)]
    nodes = merkle.manifest(frame(spark, rows)).trees.nodes().collect()
    for tree, n, height in (("=a", 70, 3), ("=b", 5, 1)):
        for level in range(height + 1):
            spans = sorted((r.lo, r.hi) for r in nodes if r.tree == tree and r.level == level)
            assert spans[0][0] == 0 and spans[-1][1] == n
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert max(r.level for r in nodes) == 3


def test_empty_table(spark):
    assert audit(spark, []) == []
