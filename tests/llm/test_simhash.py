import random

import numpy as np
import pytest
import xxhash

from triplex.llm.simhash import block_masks, bucket_links, components, drop_near_copies, fingerprint, links, near_duplicates


def slow_fingerprint(text):
    words = bytes((text or "").encode()).lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def classes(fps, bits=3):
    """Smallest id reachable over links of ``bits`` or fewer differing bits, by brute force."""
    ids = list(fps)
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fps[a] ^ fps[b]).bit_count() <= bits and best[b] < best[a]:
                    best[a], changed = best[b], True
    return best


@pytest.mark.parametrize("text", [None, "", " \t\r\n\v\f", "One", "one TWO", "a b c", "a  b\tc\nd", "É é Ä ß A",
                                  "nbsp stays one word", " ".join(str(i % 70) for i in range(2000))])
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_every_near_pair_shares_a_block_key():
    rnd = random.Random(5)
    masks = block_masks(3)
    assert len(masks) == 20
    for _ in range(300):
        a, flips = rnd.getrandbits(64), sum(1 << b for b in rnd.sample(range(64), 3))
        assert any((a ^ (a ^ flips)) & m % 2**64 == 0 for m in masks)


def test_bucket_links_join_exactly_the_near_ones():
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(6)]
    fp = np.array([b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 4))) for b in base for _ in range(30)], np.uint64)
    refs = np.array([rnd.getrandbits(64) for _ in range(16)], np.uint64)
    table = np.bitwise_count(fp[:, None] ^ refs).astype(np.int16)
    u, v = bucket_links(np.zeros(len(fp), int), fp, table, 3)
    want = classes(dict(enumerate(map(int, fp))))
    root = {int(f): int(f) for f in fp}
    root.update({int(a): int(b) for a, b in zip(u, v)})
    for i in range(len(fp)):
        for j in range(i):
            assert (want[i] == want[j]) == (root[int(fp[i])] == root[int(fp[j])])


def test_links_and_components_of_a_chain_and_a_ball(spark):
    rnd = random.Random(9)
    base = rnd.getrandbits(60)
    chain = [base ^ ((1 << 3 * i) - 1) for i in range(20)]  # neighbours differ in three bits, ends in 57
    centre = rnd.getrandbits(60)
    ball = list({centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)})
    lone = [rnd.getrandbits(60) for _ in range(200)]
    fps = list({*chain, *ball, *lone})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in components(links(df, 3)).collect()}
    want = classes({f: f for f in fps})
    assert {f: got.get(f, f) for f in fps} == want
    assert links(df, 3).count() <= 20 * len(fps)  # trees, not all pairs


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def edited(rnd, text, n):
    words = text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = "changed"
    return " ".join(words)


def test_against_brute_force(make_docs):
    rnd = random.Random(3)
    long_text = " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(400)) for _ in range(3000))
    rows = [(i + 1, edited(rnd, long_text, rnd.randrange(6))) for i in range(40)]
    rows += [(100 + i, " ".join(str(rnd.randrange(10**6)) for _ in range(50))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, " "), (203, "one"), (204, "ONE"), (205, "w " * 200_000), (5, rows[4][1])]
    got = near_duplicates(make_docs(rows)).collect()
    assert len(got) == len(rows)
    fps = {i: slow_fingerprint(t) for i, t in rows if i != 205} | {205: fingerprint("w " * 200_000)}
    want = classes(fps)
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == sorted((i, fps[i], want[i]) for i, _ in rows)
    left = drop_near_copies(make_docs(rows))
    assert sorted({r.doc_id for r in left.collect()}) == sorted(set(want.values()))


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def test_small_documents_table_against_brute_force(llm_documents):
    rows = llm_documents.select("doc_id", "text").collect()
    fps = {r.doc_id: fingerprint(r.text) for r in rows}
    got = {r.doc_id: r.component_id for r in near_duplicates(llm_documents).collect()}
    assert got == classes(fps)


def test_near_fingerprints_share_a_pivot_cell(spark):
    from triplex.llm.simhash import _signed, pivot_cells, pivot_table

    rnd = random.Random(11)
    pairs = []
    for _ in range(200):
        a = rnd.getrandbits(64)
        pairs.append((a, a ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3)))))
    fps = spark.createDataFrame([(_signed(x), i, s) for i, p in enumerate(pairs) for s, x in enumerate(p)], "fp long, i int, side int")
    from pyspark.sql import functions as F

    cells = pivot_table(fps).select("i", "side", F.array(*pivot_cells(3)).alias("c")).collect()
    found = {(r["i"], r["side"]): set(r["c"]) for r in cells}
    assert all(len(c) == 16 for c in found.values())
    assert all(found[i, 0] & found[i, 1] for i in range(len(pairs)))


@pytest.mark.parametrize("max_bucket", [1, 3, 1 << 15])
def test_dealing_out_buckets_loses_no_link(spark, max_bucket):
    from triplex.llm.simhash import _signed

    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(4)]
    fps = [b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 4))) for b in base for _ in range(25)]
    df = spark.createDataFrame([(_signed(f),) for f in set(fps)], "fp long")
    found = {r["node"]: r["root"] for r in components(links(df, 3, max_bucket=max_bucket)).collect()}
    order = sorted(set(fps))
    want = classes(dict(enumerate(order)))
    for i, a in enumerate(order):
        for j, b in enumerate(order[:i]):
            same = found.get(_signed(a), a) == found.get(_signed(b), b)
            assert same == (want[i] == want[j])


def test_a_bucket_that_is_one_tree_ends_early():
    fp = np.array([1 << (i % 3) for i in range(3)] + [0], np.uint64)
    many = np.tile(fp, 500)
    table = np.zeros((len(many), 16), np.int16)
    u, v = bucket_links(np.zeros(len(many), int), many, table, 3)
    assert len(u) == len(many) - 1 and len(set(v.tolist())) == 1
