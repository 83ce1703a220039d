"""Incremental ingest equals the batch cleaning of the same files."""

import os

from pyspark.sql import functions as F

from triplex.operators.triples import clean_triples
from triplex.schema import TRIPLE_COLUMNS
from triplex.session import scratch_path
from triplex.sources.tables import raw_triples
from triplex.sources.triples import read_triples
from triplex.streaming.ingest import start_ingest


def test_ingest_available_now(spark, sf_small):
    src = scratch_path(spark, "t-stream-src")
    tr = raw_triples(spark, sf_small).where(~F.col("Object").rlike("[\t\r\n]"))
    tr.select(F.concat_ws("\t", *TRIPLE_COLUMNS, F.lit(".")).alias("v")).write.text(src)
    out = scratch_path(spark, "t-stream-out")
    q = start_ingest(spark, src, out, mode="ntriples")
    q.awaitTermination(120)
    got = spark.read.parquet(out).select(*TRIPLE_COLUMNS)
    want = clean_triples(read_triples(spark, src, "ntriples"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    assert os.path.isdir(out)


def test_ingest_resumes_from_checkpoint(spark, sf_small):
    src = scratch_path(spark, "t-stream-src2")
    out = scratch_path(spark, "t-stream-out2")
    ckpt = scratch_path(spark, "t-stream-ckpt2")
    tr = raw_triples(spark, sf_small).where(~F.col("Object").rlike("[\t\r\n]"))
    lines = tr.select(F.concat_ws("\t", *TRIPLE_COLUMNS, F.lit(".")).alias("v"))
    first, second = lines.randomSplit([0.5, 0.5], seed=11)
    first.write.text(src + "/a")
    q = start_ingest(spark, src + "/*", out, checkpoint=ckpt, mode="ntriples")
    q.awaitTermination(120)
    n1 = spark.read.parquet(out).count()
    second.write.text(src + "/b")
    q = start_ingest(spark, src + "/*", out, checkpoint=ckpt, mode="ntriples")
    q.awaitTermination(120)
    n2 = spark.read.parquet(out).count()
    assert n1 == first.count() and n2 == n1 + second.count()


def test_starts_without_a_checkpoint_lose_no_new_file(spark, tmp_path):
    from triplex.streaming.ingest import start_ingest

    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for n in range(3):
        lines = [f"<s{n}{i}>\t<p>\t<o\rx>\t.\n" for i in range(5)]
        (folder / f"part-{n}.tsv").write_text("".join(lines), newline="")
        start_ingest(spark, str(folder), out, mode="ntriples").awaitTermination()
        assert spark.read.parquet(out).count() == 5 * (n + 1)


def test_a_new_checkpoint_on_a_written_output_is_refused(spark, tmp_path):
    import pytest

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.tsv").write_text("<s>\t<p>\t<o>\t.\n")
    start_ingest(spark, str(src), out, checkpoint=str(tmp_path / "one")).awaitTermination()
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(ValueError, match="another checkpoint"):
        start_ingest(spark, str(src), out, checkpoint=str(tmp_path / "two"))
    (src / "b.tsv").write_text("<s2>\t<p>\t<o>\t.\n")
    start_ingest(spark, str(src), out, checkpoint=str(tmp_path / "one")).awaitTermination()
    assert spark.read.parquet(out).count() == 2
