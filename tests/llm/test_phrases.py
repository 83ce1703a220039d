import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from triplex.llm import phrases

M = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M
    return x ^ (x >> 31)


def coin(left, own):
    bit = ((left ^ own) & -(left ^ own)).bit_length() - 1
    return 2 * bit + (own >> bit & 1)


def parse(text):
    """Phrase names of each level, straight from the definition."""
    symbols, levels = [ord(c) for c in text], []
    while symbols and (not levels or len(symbols) > 1):
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        label = [s for s, _ in runs]
        for _ in range(4):
            label = [coin(label[i - 1] if i else x ^ 1, x) for i, x in enumerate(label)]
        starts = [0] + [
            i for i in range(2, len(runs) - 1) if label[i] > label[i - 1] and label[i] > label[i + 1]
        ]
        names = []
        for a, b in zip(starts, [*starts[1:], len(runs)]):
            total = sum(
                mixed((s * 0x9E3779B97F4A7C15 + k * 0xC2B2AE3D27D4EB4F + j * 0x165667B19E3779F9) & M)
                for j, (s, k) in enumerate(runs[a:b])
            )
            names.append(mixed((total + (len(levels) + 1) * 0x165667B19E3779F9) & M))
        levels.append(names)
        symbols = names
    return levels


def brute_sketch(text):
    levels = parse(text)
    ranks = set()
    for k, names in enumerate(levels):
        seen = Counter()
        for r in (n >> 36 for n in names):
            i = seen[r]
            seen[r] += 1
            if i:
                r = mixed((r * 0x9E3779B97F4A7C15 + i * 0xC2B2AE3D27D4EB4F) & M) >> 36
            ranks.add(r * (16 if k == 0 else 1))
    return (levels[-1][0] if levels else 0), sorted(ranks)[: phrases.SIZE]


def texts(seed):
    rng = random.Random(seed)
    out = ["", "a", "ab", "aa", "aaaa", "abc", "abab" * 50, "é語\U0001f600" * 9, "\n" * 3000]
    words = ["".join(rng.choices("abcdefghij ", k=rng.randint(1, 9))) for _ in range(200)]
    out += [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(30)]
    return out


@pytest.mark.parametrize("batch", [7, 100, 1 << 18])
def test_sketches_match_the_definition(monkeypatch, batch):
    monkeypatch.setattr(phrases, "BATCH", batch)
    found = phrases.sketches(texts(1))
    assert [(t, r.tolist()) for t, r in found] == [brute_sketch(t) for t in texts(1)]


def test_labels_differ_and_phrases_are_short():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 40, 5000).astype(np.uint64)
    symbols = symbols[np.r_[True, symbols[1:] != symbols[:-1]]]
    first = np.zeros(len(symbols), bool)
    first[[0, 100, 101, 103]] = True
    label = phrases.labels(symbols, first)
    assert label.max() <= 5
    same_text = ~first[1:]
    assert (label[1:] != label[:-1])[same_text].all()
    sizes = np.diff(np.append(phrase := phrases.phrase_starts(label, first), len(symbols)))
    assert sizes.max() <= 14 and (sizes >= 2)[~np.isin(phrase, [100])].all()


def test_equal_substrings_have_equal_interior_names():
    rng = random.Random(4)
    core = "".join(rng.choices("abcdefgh ", k=4000))
    shifted = [parse("x" * k + "qrs"[: k % 3] + core + "tuv" * k) for k in range(6)]
    plain = parse(core)
    for level, margin in ((0, 8), (1, 8), (2, 8)):
        inner = plain[level][margin:-margin]
        assert len(inner) > 20
        for other in shifted:
            text = other[level]
            assert any(text[i : i + len(inner)] == inner for i in range(len(text) - len(inner) + 1))


def test_likeness_orders_texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(2000)]
    a, b = (" ".join(rng.choices(words, k=500)) for _ in range(2))
    one, two, some = phrases.sketches([a, b, phrases.edited(a, b)])
    assert phrases.likeness(one, one) == 1.0
    assert phrases.likeness(one, some) > 0.4 > 0.2 > phrases.likeness(one, two)


def test_a_repeated_passage_counts_for_what_it_fills():
    rng = random.Random(8)
    line = "the same line again and again. " * 400
    other = "".join(rng.choices("abcdefgh ", k=5000))
    one, some = phrases.sketches([line, phrases.edited(line, other)])
    assert phrases.likeness(one, some) > 0.4


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).digest()))
    out = []
    for (doc_id, text), (_, following) in zip(rows, [*rows[1:], rows[0]] if rows else []):
        text, following = text or "", following or ""
        new = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        own, other, some = phrases.sketches([text, following, new])
        out.append((
            doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), phrases.to_bytes(own).hex(),
            phrases.to_bytes(some).hex(), phrases.likeness(own, some), phrases.likeness(own, other),
        ))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r[0], r[1], *(bytes(x).hex() for x in r[2:5]), *r[5:]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("batch", [50, 1 << 18])
def test_neighbours_match_brute_force(spark, make_docs, batch):
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts(6))]
    rows += [(None, None), (None, "x y z"), (2**53 + 1, "big id"), (2**53, "another"), (5, "same"), (5, "same"), (5, "other")]
    rows.append((7, "long " * 60000))
    assert got(phrases.compare_neighbours(make_docs(rows), batch=batch)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "only one text here")], [(1, None)], [(1, "a b c d"), (2, "e f g h")]])
def test_small_tables(spark, make_docs, rows):
    assert got(phrases.compare_neighbours(make_docs(rows))) == brute(rows)


def test_equal_texts_have_equal_fingerprints(spark, make_docs):
    rows = [(i, "same text here" if i % 2 else f"text {i}") for i in range(40)] + [(None, "same text here")]
    found = phrases.fingerprints(make_docs(rows)).collect()
    assert len({bytes(r.fingerprint) for r in found if r.doc_id is None or r.doc_id % 2}) == 1
    assert len({bytes(r.fingerprint) for r in found}) == 21
