"""Layout of tables, as data (SRC-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.schemas import KEYS, TABLES

_ROW = "name string, type string, nullable boolean, position int"


def table_info(df: DataFrame) -> DataFrame:
    """``name``, ``type``, ``nullable`` and ``position`` (from 1) of each column."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, _ROW)


def tables(spark: SparkSession) -> DataFrame:
    """``table``, ``key`` (names of its columns) and ``columns`` of each of the engine's tables."""
    rows = [(name, list(KEYS[name]), spark.createDataFrame([], ddl).columns) for name, ddl in TABLES.items()]
    return spark.createDataFrame(rows, "table string, key array<string>, columns array<string>")
