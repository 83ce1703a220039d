"""Schemas of the relations the library reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

SUBJECT, PREDICATE, OBJECT = "Subject", "Predicate", "Object"
TRIPLE_COLUMNS = [SUBJECT, PREDICATE, OBJECT]

# Line format of the dump: three fields plus the trailing "." field.
RAW_TRIPLE_SCHEMA = StructType(
    [
        StructField(SUBJECT, StringType(), True),
        StructField(PREDICATE, StringType(), True),
        StructField(OBJECT, StringType(), True),
        StructField("Blank", StringType(), True),
    ]
)

TRIPLE_SCHEMA = StructType([StructField(c, StringType(), True) for c in TRIPLE_COLUMNS])

PREDICATE_LIST_SCHEMA = StructType([StructField(PREDICATE, StringType(), True)])

# Flattened predicate hierarchy: one row per dotted prefix (node).
HIERARCHY_SCHEMA = StructType(
    [
        StructField("path", StringType(), False),
        StructField("parent", StringType(), True),
        StructField("part", StringType(), True),
        StructField("depth", LongType(), False),
        StructField("is_leaf", BooleanType(), False),
    ]
)

# Counters of runs; a folder for each run.
LEDGER_SCHEMA = StructType(
    [
        StructField("input", StringType(), True),
        StructField("metric", StringType(), True),
        StructField("value", LongType(), True),
        StructField("written", DoubleType(), True),
        StructField("run_id", StringType(), True),
    ]
)

METRICS_SCHEMA = StructType(
    [
        StructField("stage", StringType(), False),
        StructField("metric", StringType(), False),
        StructField("value", DoubleType(), True),
    ]
)
