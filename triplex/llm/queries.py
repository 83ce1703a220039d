"""The registered queries of the operators of this subpackage, and their SQL.

Each query applies its operator, with production parameters, to the whole
table and derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplex.llm import (
    bloom_lm,
    bpe,
    exact_dedup,
    html_extract,
    language_id,
    maxscore,
    merkle,
    oracle,
    ownership,
    packing,
    phrases,
    sharding,
    simhash,
    spelling,
)

SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def byte_bpe() -> tuple[str, str]:
    """Rank file and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def byte_bpe_added() -> tuple[tuple[str, int], ...]:
    """``(token, id)`` of the added tokens of the vocabulary's tokenizers file."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    for t in added:
        if any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {t['content']!r} is not matched as it stands")
    return tuple((t["content"], t["id"]) for t in added)


def op1_simhash_near_dedup(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_lm_scoring(spark, d):
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return bloom_lm.score(table(spark, d, "documents"), remainder != 2)


def op3_language_id(spark, d):
    docs = table(spark, d, "documents")
    out = language_id.held_out()
    found = language_id.predict(docs, language_id.fit(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_maxscore(spark, d):
    vectors = table(spark, d, "embeddings")
    return maxscore.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op5_packing(spark, d):
    docs = table(spark, d, "documents")
    pieces = packing.pack(docs, packing.text_ids(*byte_bpe(), added=byte_bpe_added()), checksum_only=True)
    return pieces.select(
        "doc_id", "start", "length", F.conv(F.hex("ids"), 16, 10).cast("long").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op6_secret_scans(spark, d):
    return ownership.scan(table(spark, d, "documents"))


def op7_bpe(spark, d):
    coded = bpe.encode(table(spark, d, "documents"), *byte_bpe(), digests=True)
    return coded.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op8_html_extraction(spark, d):
    found = html_extract.extract(table(spark, d, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_exact_dedup(spark, d):
    found = exact_dedup.exact_dedup(table(spark, d, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_sharding(spark, d):
    placed = sharding.assign_shards(table(spark, d, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op11_merkle_manifest(spark, d):
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.audit(
        table(spark, d, "documents"), {"text": F.translate(F.col("text"), oracle.CAPITALS, oracle.SMALL)}, picked
    )
    return found.withColumnRenamed("key", "doc_id")


def op12_document_fingerprints(spark, d):
    found = phrases.compare_neighbours(table(spark, d, "documents"))
    as_hex = {c: F.lower(F.hex(c)) for c in ("edited_digest", "fingerprint", "edited_fingerprint")}
    return found.select(
        "doc_id", "n_chars", as_hex["edited_digest"].alias("edited_sha256"),
        as_hex["fingerprint"].alias("fingerprint"), as_hex["edited_fingerprint"].alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op13_spelling_variants(spark, d):
    return spelling.variants(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_language_id": op3_language_id,
    "op4_maxscore": op4_maxscore,
    "op5_packing": op5_packing,
    "op6_secret_scans": op6_secret_scans,
    "op7_bpe": op7_bpe,
    "op8_html_extraction": op8_html_extraction,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_merkle_manifest": oracle.merkle(),
    "op13_spelling_variants": oracle.spelling(),
}
