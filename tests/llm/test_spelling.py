import random
import re
import zlib
from collections import Counter

import pytest

from triplex.llm import spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(u) + 1 == len(v) and any(u == v[:i] + v[i + 1 :] for i in range(len(v)))


def brute_words(rows, min_length=7, min_count=2):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            if len(run) >= min_length:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= min_count}


def brute(rows, **kw):
    words = brute_words(rows, **kw)
    form, near = {}, {}
    for w in words:
        near[w] = [v for v in words if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def edited(rng, word, letters):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])


def corpus(seed, letters, base, copies):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(6, 11))) for _ in range(base)]
    rows = []
    for i in range(copies):
        text = []
        for w in rng.choices(words, weights=[1 / (k + 1) for k in range(base)], k=30):
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                w = edited(rng, w, letters)
            text.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((rng.choice([i, None, 2**53 + 1]), rng.choice([" ", ", ", "1"]).join(text)))
    return rows


@pytest.mark.parametrize("letters", ["ab", "abcdeéÿ×", "abcdefghijklmnopqrstuvwxyzàü"])
def test_matches_brute_force(spark, make_docs, letters):
    rows = corpus(len(letters), letters, 60, 120)
    assert got(spelling.variants(make_docs(rows))) == brute(rows)


@pytest.mark.parametrize("max_part", [1, 3, 20])
def test_cutting_large_parts_loses_no_pair(spark, make_docs, max_part):
    shared = " ".join("prefixprefix" + a + b for a in "xyzuv" for b in "xyzuv")
    rows = corpus(5, "aab", 40, 80) + [(1, shared)] * 3
    assert got(spelling.variants(make_docs(rows), max_part=max_part)) == brute(rows)


def test_each_pair_is_found_once():
    rng = random.Random(3)
    for length, low, high in ((4, 0, 2), (4, 2, 5), (4, 3, 4), (4, 4, 5), (4, 0, 5)):
        tail = max(0, length - high)
        cores = {"".join(rng.choices("ab", k=k)) for k in (length - low - tail, length - low - tail + 1) for _ in range(30)}
        words = ["z" * low + c + "y" * tail for c in cores]
        found = spelling.part_pairs(words, length, low, high)
        first = lambda u, v: next((i for i, (a, b) in enumerate(zip(u, v)) if a != b), min(len(u), len(v)))
        want = {
            (u, v) for u in words for v in words
            if len(u) == length and one_edit(u, v) and (len(v) > length or u < v) and low <= first(u, v) < high
        }
        assert len(found) == len(set(found)) and set(found) == want


def test_acceptor_is_minimal_and_numbers_its_words():
    words = sorted(["tapped", "tapping", "mapped", "mapping", "map"])
    found = spelling.Acceptor(words)

    def spelled(state, before):
        if found.final[state]:
            yield before
        for c, (t, _) in found.edges[state].items():
            yield from spelled(t, before + c)

    assert list(spelled(found.start, "")) == words
    assert found.count[found.start] == len(words)
    assert len(found.final) < sum(map(len, words))
    for number, word in enumerate(words):
        state, at = found.start, 0
        for c in word:
            state, skipped = found.edges[state][c]
            at += skipped
        assert at == number


def test_chain_of_forms_ties_and_factor(spark, make_docs):
    rows = [(0, " ".join(["spelling"] * 400 + ["spellling"] * 30 + ["spelllling"] * 3 + ["spellxng"] * 400 + ["spellang"] * 40))]
    want = brute(rows)
    assert got(spelling.variants(make_docs(rows))) == want
    roots = {w: r for w, _, r, *_ in want}
    assert len(set(roots.values())) < len(roots)


def test_odd_rows(spark, make_docs):
    long = "ab" * 40000
    rows = [(None, None), (1, ""), (2, "short"), (3, f"{long} {long} {long}x {long}x"), (4, "1234567 _______"), (5, "wordword " * 20000)]
    assert got(spelling.variants(make_docs(rows))) == brute(rows)
    assert got(spelling.variants(make_docs([]))) == []
