"""Ids beyond 2^53 beside a null in one batch, through every operator that uses Python."""

import pytest

from triplex.llm import bloom_lm, bpe, language_id, packing, phrases, simhash
from triplex.llm.queries import byte_bpe

BIG = 2**53 + 1
ROWS = [(BIG, "one two three four"), (None, "no id here at all"), (BIG - 2, "five six seven eight"), (7, None)]


def lm(docs):
    from pyspark.sql import functions as F

    return bloom_lm.score(docs, F.lit(True))


def lm_dealt(docs):
    from pyspark.sql import functions as F

    return bloom_lm.score(docs, F.lit(True), max_bits=1 << 10)


OPERATORS = {
    "simhash": lambda d: simhash.near_duplicates(d),
    "bloom_lm": lm,
    "bloom_lm_dealt": lm_dealt,
    "language_id": lambda d: language_id.predict(d, language_id.fit(d)),
    "packing": lambda d: packing.pack(d, packing.text_ids(*byte_bpe())),
    "bpe": lambda d: bpe.encode(d, *byte_bpe()),
    "bpe_chunks": lambda d: bpe.encode(d, *byte_bpe(), chunk=5, overlap=4),
    "decode": lambda d: bpe.decode(bpe.encode(d, *byte_bpe()), *byte_bpe()),
    "phrases": lambda d: phrases.compare_neighbours(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_are_exact(make_docs, name):
    docs = make_docs(ROWS, lang=lambda t: "en").coalesce(1)
    found = OPERATORS[name](docs)
    assert dict(found.dtypes)["doc_id"] == "bigint"
    assert {r["doc_id"] for r in found.collect()} == {r[0] for r in ROWS}


def test_page_ids_are_exact(spark):
    from triplex.llm import html_extract

    pages = spark.createDataFrame([(i, "u", "<p>x") for i, _ in ROWS], "page_id long, url string, html string").coalesce(1)
    assert {r["page_id"] for r in html_extract.extract(pages).collect()} == {r[0] for r in ROWS}
