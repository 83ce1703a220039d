"""Frames that tests build their inputs with."""

from pyspark.sql.types import StringType, StructField, StructType

from triplex.schema import TRIPLE_SCHEMA


def triples_df(spark, rows):
    return spark.createDataFrame(rows, TRIPLE_SCHEMA)


def one_col(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField(name, StringType(), True)]))
