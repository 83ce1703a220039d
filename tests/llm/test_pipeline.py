import re

import corpus_pipeline
from triplex.llm import exact_dedup, language_id, ownership, simhash
from triplex.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    planted = docs.orderBy("doc_id").limit(3).selectExpr(
        "doc_id + 1000000 AS doc_id", "reverse(text) || ' password=' || sha1(text) AS text", "lang", "source", "n_chars"
    )
    docs = materialise(docs.unionByName(planted), "test-documents")
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, sf_small), f"test-{name}")
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            continue
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == COLUMNS and set(after) <= set(before)
        if name == "language_id":
            assert set(after) == {i for i, r in before.items() if re.search(r"[^\W\d_]", r["text"] or "")}
        if name == "exact_dedup":
            last = {r["text"]: i for i, r in sorted(before.items())}
            assert set(after) == set(last.values())
        if name == "simhash_near_dedup":
            fps = {i: simhash.fingerprint(r["text"], 3) for i, r in before.items()}
            kept = [i for i in sorted(fps) if i in after]
            assert all((fps[a] ^ fps[b]).bit_count() > 3 for n, a in enumerate(kept) for b in kept[:n])
            assert all(any((fps[i] ^ fps[j]).bit_count() <= 3 for j in fps if j != i) for i in fps if i not in after)
        if name == "secret_scans":
            assert set(after) == set(before)
            changed = [i for i in after if after[i]["text"] != before[i]["text"]]
            assert len(changed) == 3 and all(ownership.MARK in after[i]["text"] for i in changed)
            assert all(after[i]["n_chars"] == len(after[i]["text"]) for i in changed)


def test_odd_rows_go_through_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "word", None, "a", 4), (3, "word", None, "a", 4), (None, "an other", "en", "b", 8)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, "").count() <= len(rows), name
        assert stage(spark, docs.limit(0), "").count() == 0, name
    assert exact_dedup.drop_copies(docs).count() == 3
    assert language_id.keep_known(docs, language_id.fit(docs)).count() == 3


def test_near_copies_keep_one_row_of_each_component(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a), (2, b), (1, b), (None, b), (3, c), (3, c), (None, d), (None, d), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_copies(spark, docs, "")
    assert out.columns == COLUMNS
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert got == sorted([(None, a), (1, b), (3, c), (None, d), (4, "")], key=repr)


def test_a_document_without_an_id_survives_the_stages(spark):
    rows = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "an other")]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = materialise(stage(spark, docs, ""), f"test-odd-{name}")
        assert docs.where("doc_id IS NULL").count() == 1, name


def test_run_leaves_only_its_result(spark, sf_small):
    import os

    from triplex.llm import common

    before = len(common._WRITTEN)
    folder = f"{common.scratch_path(spark, 'x').rsplit('/', 1)[0]}"
    present = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = corpus_pipeline.run(spark, sf_small)
    assert found.count() > 0
    left = set(os.listdir(folder)) - present
    assert len(left) == 1 and next(iter(left)).startswith("llm-pipeline-packing")
    assert len(common._WRITTEN) == before + 1
