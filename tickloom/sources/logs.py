"""Readers of the metric logs kept as CSV with a heading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom import schemas


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.RUN_LOG)


def read_scaling_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.SCALING_LOG)


def read_load_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.LOAD_LOG)
