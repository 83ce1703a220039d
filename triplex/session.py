"""Session helpers: shared scratch locations and a local session for tests.

Library code never changes the caller's session settings, with one
exception: if no checkpoint directory is configured (local tests), a fresh
one is created so that ``checkpoint()`` and scratch exports have a home.
On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
used as given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch output.

    Read from the session (``spark.checkpoint.dir``); only when it is unset
    on a ``local[...]`` master (tests) a new temp folder is created and
    registered.  On a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        # A machine-local folder is not visible to other executors and is
        # lost with the machine: require the shared folder on a cluster.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    local = tempfile.mkdtemp(prefix="triplex-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there.

    Cuts the lineage with a table that outlives any executor, fixes generated
    row ids, and gives the planner the relation's measured size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "triplex"
) -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only what was measured: no static (estimate-based)
        # broadcast; adaptive execution converts a join to a broadcast from
        # the actual size of a finished shuffle stage.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TRIPLEX_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
