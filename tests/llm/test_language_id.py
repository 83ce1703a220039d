import zlib

import numpy as np

from triplex.llm import language_id


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = language_id.held_out()
    model = language_id.fit(docs.where(~out))
    found = language_id.predict(docs, model)
    rows = docs.select("doc_id", "lang", out.alias("out")).join(found, "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["out"] and r["lang"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.9


def test_cases(make_docs):
    rows = [(i, "the and of with thing only " * (i % 5 + 1)) for i in range(20)] + [(100 + i, "der und die ich sch ung " * (i % 4 + 1)) for i in range(20)]
    train = make_docs(rows, lang=lambda t: "en" if t.startswith("the") else "de")
    model = language_id.fit(train)
    odd = make_docs([(1, None), (2, ""), (3, "12 ... 7"), (None, "the thing with"), (5, "und die der " * 100_000), (5, "und die der"), (6, "日本")])
    got = [tuple(r) for r in language_id.predict(odd, model).collect()]
    pred = {(i, l) for i, l, _ in got}
    assert len(got) == 7 and {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "de")} <= pred
    assert all(s == 0 for _, l, s in got if l == "und")
    kept = language_id.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.count() == 4
    assert language_id.predict(odd.limit(0), model).count() == 0
    nothing = language_id.fit(train.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing).collect()} == {"und"}


def test_long_texts_are_counted_whole():
    text = "abc déf " * 400_000
    v = language_id.text_features(text)
    counted = {}
    w = language_id.text_features("abc déf " * 100)
    assert abs(float(v @ w) - 2) < 0.01 and not counted
    assert language_id.text_features(" 1 _ ") is None


def test_families_share_no_language():
    langs = [x for group in language_id.FAMILIES.values() for x in group]
    assert len(langs) == len(set(langs)) and language_id.family_of("xx") == "xx"


def test_votes_against_plain_loops():
    import math

    import numpy as np

    rng = np.random.default_rng(4)
    langs = ["en", "de", "nl", "fr", "es", "xx"]
    x = rng.normal(size=(120, 12))
    label = [langs[i % 6] for i in range(120)]
    for i, lang in enumerate(label):
        x[i, langs.index(lang)] += 2.0
    model = language_id.Model(x, label)

    def choose(level, v):
        names, pairs, weights = model.levels[level]
        if len(names) == 1:
            return names[0], 1.0
        votes, sums, won = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), {}
        for (a, b), w in zip(pairs, weights):
            m = sum(p * q for p, q in zip(w, v))
            votes[names[a] if m >= 0 else names[b]] += 1
            sums[names[a]] += m
            sums[names[b]] -= m
            won[names[a], names[b]], won[names[b], names[a]] = m, -m
        best = sorted(names, key=lambda n: (-votes[n], -sums[n], n))[0]
        return best, 1 / (1 + math.exp(-3 * min(m for (a, _), m in won.items() if a == best)))

    for v in rng.normal(size=(200, 12)):
        family, p = choose("", v)
        lang, q = choose(f"{family}/", v)
        got, score = model.predict(v)
        assert got == lang and abs(score - min(1.0, p * q)) < 1e-9
    assert {model.predict(v)[0] for v in x} == set(langs)


def test_only_letters_count_as_letters():
    for text in (None, "", "12 3.4 !?", "² ½ Ⅻ ①", "\u0301 _ ,"):
        assert language_id.text_features(text) is None, text
    same = language_id.text_features("a b")
    assert (language_id.text_features("a² b½") == same).all() and (language_id.text_features("A  ①b") == same).all()
