import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from triplex.llm import bloom_lm as lm


def words(text):
    import re

    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + ["<end>"]


ROWS = [(i, "The quick  brown\tfox é\x0bÉ jumps\x0c over " * (i % 4) + f"w{i % 7} A b") for i in range(60)]
ROWS += [(100, None), (101, ""), (102, "the " * 300_000), (103, "rare words only"), (103, "rare words only"), (None, "the x")]


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 3])
def test_base_score_against_brute_force(make_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    training = F.col("doc_id") % 3 != 2
    got = lm.score(make_docs(ROWS), training).collect()
    learn = [t for i, t in ROWS if i is None or i % 3 != 2]
    count = Counter(w for t in learn for w in words(t))
    total, distinct = sum(count.values()), len(count)
    assert len(got) == len(ROWS)
    want = sorted(
        (i is not None and i % 3 == 2, i or -1, len(words(t)), sum(w in count for w in words(t)),
         sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in words(t)))
        for i, t in ROWS
    )
    for r, w in zip(sorted((r["held_out"], r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["base_score"]) for r in got), want):
        assert r[:4] == w[:4] and r[4] == pytest.approx(w[4])
    assert {r["train_tokens"] for r in got} == {total}
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_filter_reads_back_every_level(spark):
    h = np.random.default_rng(3).integers(-(2**62), 2**62, 5000)
    n = np.random.default_rng(4).integers(1, 900, 5000)
    counts = spark.createDataFrame([(int(a), True, int(b)) for a, b in zip(h, n)], "h long, single boolean, n long")
    f = lm.build_filter(counts)
    got = lm.read_levels(f.data, f.chunks, h.view(np.uint64))
    assert (got >= lm.level(n)).all() and (got == lm.level(n)).mean() > 0.95
    assert (f.total, f.distinct) == (int(n.sum()), 5000)
    absent = lm.read_levels(f.data, f.chunks, np.arange(10_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert (absent == 0).mean() > 0.95


def test_scores_do_not_depend_on_batches(monkeypatch):
    hashes = [lm.token_hashes(lm.tokens(t)) for _, t in ROWS[:40]]
    f = lm.Filter(np.random.default_rng(5).integers(0, 256, lm.CHUNK_BITS // 8).astype(np.uint8), 1, 1000, 50)
    whole = f.log10_scores(hashes)
    assert np.allclose(whole, [f.log10_scores([h])[0] for h in hashes])
    monkeypatch.setattr(lm, "TOKENS_TOGETHER", 7)
    assert np.allclose(whole, f.log10_scores(hashes))


def test_empty_table(make_docs):
    assert lm.score(make_docs(ROWS).limit(0), F.lit(True)).count() == 0


def test_a_filter_beyond_the_broadcast_gives_the_same_scores(make_docs, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{n}" for n in rng.zipf(1.3, 90) % 4000)) for i in range(400)] + [(None, None), (7, "w1 w1 never")]
    docs, training = make_docs(rows), F.col("doc_id") % 3 != 2
    monkeypatch.setattr(lm, "PROBED_CHUNKS", 2)
    monkeypatch.setattr(lm, "DEALT_CHARS", 5000)

    def found(max_bits):
        out = lm.score(docs, training, max_bits=max_bits).collect()
        return sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in out)

    bits = lm.filter_totals(lm.ngram_counts(docs.where(F.coalesce(training, F.lit(True)))))[0]
    assert bits >= 4 * lm.CHUNK_BITS  # one chunk, the bound below, would be nearly full
    assert found(lm.CHUNK_BITS) == found(lm.MAX_BITS)


def quantised(c):
    """The count that the log-frequency scale keeps of a count."""
    if not c:
        return 0.0
    q = math.floor(math.log2(c) + 1e-9)
    return max(1.0, (2.0**q + 2.0 ** (q + 1) - 1) / 2)


@pytest.mark.parametrize("max_bits", [lm.MAX_BITS, 1 << 10])
def test_score_against_brute_force(make_docs, max_bits):
    """With so few n-grams the filter gives no wrong answer, so its scores are those of plain counts."""
    rows = [r for r in ROWS if r[0] != 102]
    one, two = Counter(), Counter()
    for i, t in rows:
        if i is None or i % 3 != 2:
            one.update(words(t))
            two.update(zip(words(t), words(t)[1:]))
    total, distinct = sum(one.values()), len(one)

    def score(text):
        out, before = 0.0, None
        for w in words(text):
            p = min(1.0, (quantised(one[w]) + 1) / (total + distinct + 1))
            known = quantised(one[before]) if before is not None else 0.0
            if known:
                p = 0.7 * min(quantised(two[before, w]), known) / known + 0.3 * p
            out, before = out + math.log10(p), w
        return out

    got = lm.score(make_docs(rows), F.col("doc_id") % 3 != 2, max_bits=max_bits).collect()
    assert sorted(r["score"] for r in got) == pytest.approx(sorted(score(t) for _, t in rows))
