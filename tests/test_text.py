"""Tokenizer and stop words: golden rows and equality with Spark ML stages."""

from helpers import one_col
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from triplex.constants import ENGLISH_STOP_WORDS, TOKEN_SPLIT_REGEX
from triplex.functions.text import long_only_stop_words, remove_stop_words, tokenize
from triplex.operators.tokens import token_frequency, with_tokens
from triplex.sources.tables import load_table


def test_stop_words_equal_spark_default(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokenize_golden(spark):
    df = one_col(spark, "t", ["", "Été 3x", "Hello, World!! hello", "a1b2c", None])
    got = [r[0] for r in df.select(tokenize("t")).collect()]
    assert got == [[], ["été", "x"], ["hello", "world", "hello"], ["a", "b", "c"], None]


def test_stop_words_keep_repeats(spark):
    df = one_col(spark, "t", ["the cat and the cat"])
    assert df.select(remove_stop_words(tokenize("t"))).first()[0] == ["cat", "cat"]


def test_long_only_rule(spark):
    short = "the cat"
    long = "the cat sat on the mat and it was a very long sentence indeed"
    df = one_col(spark, "t", [short, long])
    got = [r[0] for r in df.select(long_only_stop_words(tokenize("t"), "t")).collect()]
    assert got[0] == ["the", "cat"]
    assert "the" not in got[1] and "cat" in got[1]


def test_equal_to_ml_stages_on_documents(spark, sf_small):
    docs = load_table(spark, sf_small, "documents").select("doc_id", "text")
    tok = RegexTokenizer(inputCol="text", outputCol="ml_tok", pattern=TOKEN_SPLIT_REGEX)
    swr = StopWordsRemover(inputCol="ml_tok", outputCol="ml_nostop")
    ml = swr.transform(tok.transform(docs))
    ours = ml.select(
        "doc_id", "ml_tok", "ml_nostop", tokenize("text").alias("t"), remove_stop_words(tokenize("text")).alias("n")
    )
    bad = ours.where((F.col("ml_tok") != F.col("t")) | (F.col("ml_nostop") != F.col("n"))).count()
    assert ours.count() > 0 and bad == 0


def test_token_frequency_counts_a_repeated_id_once(spark):
    df = spark.createDataFrame([(1, "one two one"), (1, "one"), (2, "two"), (None, "two")], "id long, text string")
    got = {tuple(r) for r in token_frequency(df, "text", "id").select("token", "n", "n_rows").collect()}
    assert got == {("one", 3, 1), ("two", 3, 2)}


def test_token_frequency_matches_python(spark, sf_small):
    import collections
    import re

    docs = load_table(spark, sf_small, "documents").select("doc_id", "text")
    got = {r["token"]: (r["n"], r["n_rows"]) for r in token_frequency(docs, "text", "doc_id").collect()}
    n, rows = collections.Counter(), collections.defaultdict(set)
    for r in docs.collect():
        for t in re.split(r"[^\w]+|[\d_]+", r["text"].lower()):
            if t:
                n[t] += 1
                rows[t].add(r["doc_id"])
    # Python's \w is letters+digits+underscore; removing digits/underscore
    # leaves letters, so the two splits agree on letter runs.
    assert got == {t: (n[t], len(rows[t])) for t in n}


def test_with_tokens_modes(spark):
    df = one_col(spark, "t", ["The end"])
    assert with_tokens(df, "t", "none").first()["tokens"] == ["the", "end"]
    assert with_tokens(df, "t", "all").first()["tokens"] == ["end"]
    assert with_tokens(df, "t", "long_only").first()["tokens"] == ["the", "end"]
