"""A ledger of run counters: rows beside the data, added up without counting anything twice.

A run writes ``input, metric, value, written`` rows into its own folder
(``run_id=...``) of the ledger; writing again replaces that folder, so a retry
of a run leaves one set of rows.  Totals take, for each input, the rows of the
run that was written last, so a second run over the same input replaces the
first, and counters of different inputs add up.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplex.schema import LEDGER_SCHEMA


def record(spark: SparkSession, path: str, run_id: str, counters: dict[str, dict[str, int]]) -> None:
    """Write the counters of a run, ``{input: {metric: value}}``; its earlier rows are replaced."""
    now = time.time()
    rows = [(name, metric, int(value), now, run_id) for name, c in counters.items() for metric, value in c.items()]
    (
        spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger: ``input, metric, value, written, run_id``."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def current(ledger: DataFrame) -> DataFrame:
    """``input, run_id, metric, value``: the rows of the run that was written last for each input."""
    last = ledger.groupBy("input").agg(F.max(F.struct("written", "run_id")).alias("last")).select(
        F.col("input").alias("_input"), F.col("last.run_id").alias("_run")
    )
    same = F.col("input").eqNullSafe(F.col("_input")) & (F.col("run_id") == F.col("_run"))
    return ledger.join(last, same, "left_semi").select("input", "run_id", "metric", "value")


def totals(ledger: DataFrame) -> DataFrame:
    """``metric, value``: counters added up over inputs."""
    return current(ledger).groupBy("metric").agg(F.sum("value").alias("value"))
