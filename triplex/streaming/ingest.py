"""Incremental ingest: new triple files -> cleaned Parquet, with Structured Streaming.

The batch operators are DataFrame -> DataFrame functions, so the stateless
part of the run (scan + clean + sample unit) applies unchanged to a
streaming DataFrame.  Whole-table dedup is *not* done here: exact dedup
over an unbounded stream needs unbounded state; it stays a batch step over
the ingested table (``triplex.plans.batch``).

Progress is tracked in a checkpoint folder inside the output folder (unless
the caller names another), beside the sink's own log: a restarted query, in
this session or a later one, resumes without re-ingesting or losing files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from triplex.operators.domains import SAMPLE_UNIT, sample_unit
from triplex.operators.triples import clean_triples
from triplex.schema import RAW_TRIPLE_SCHEMA, TRIPLE_COLUMNS


def stream_triples(spark: SparkSession, folder: str, mode: str = "compat", max_files: int | None = None) -> DataFrame:
    """Streaming scan of tab-separated triple files arriving in ``folder``."""
    reader = (
        spark.readStream.schema(RAW_TRIPLE_SCHEMA)
        .option("sep", "\t")
        .option("header", "false")
        .option("lineSep", "\n")
    )
    if mode == "ntriples":
        reader = reader.option("quote", "").option("escape", "")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.csv(folder).drop("Blank")


def stream_cleaned(spark: SparkSession, folder: str, mode: str = "compat") -> DataFrame:
    """Cleaned triples (plus the raw-triple sample unit) of a triple stream."""
    raw = stream_triples(spark, folder, mode)
    return clean_triples(raw.select(*TRIPLE_COLUMNS, sample_unit().alias(SAMPLE_UNIT)))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def start_ingest(
    spark: SparkSession,
    folder: str,
    out_path: str,
    checkpoint: str | None = None,
    mode: str = "compat",
    available_now: bool = True,
) -> StreamingQuery:
    """Start the incremental ingest into ``out_path`` (Parquet, append-only).

    ``available_now`` processes every file present and stops; otherwise the
    query keeps running and picks up new files each trigger.  A new
    checkpoint is refused for an output that an earlier ingest wrote: the
    sink's log would take its first batches for ones it has already.
    """
    own = f"{out_path.rstrip('/')}/_ingest_checkpoint"
    if checkpoint and checkpoint.rstrip("/") != own:
        if _exists(spark, f"{out_path}/_spark_metadata") and not _exists(spark, f"{checkpoint}/offsets"):
            raise ValueError(f"{out_path} was written under another checkpoint; name that one or another output")
    checkpoint = checkpoint or own
    writer = (
        stream_cleaned(spark, folder, mode)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
