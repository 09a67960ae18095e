"""Catalog tables, seeds and inline rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.functions.columns import aligned
from ledgerlake.sinks.tables import publish, restored
from ledgerlake.sources.files import read_csv


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_or_init(spark: SparkSession, name: str, first: Callable[[], DataFrame]) -> DataFrame:
    """The stored table, or what the first run starts from."""
    restored(spark, name)
    return spark.table(name) if spark.catalog.tableExists(name) else first()


def load_seed(
    spark: SparkSession,
    source: str,
    table: str,
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """Load a CSV file into a table; with no schema the types are inferred."""
    publish(spark, read_csv(spark, source, schema), table, path)
    return spark.table(table)


def bulk_load(spark: SparkSession, source: str, table: str) -> DataFrame:
    """Append a CSV file to an existing table, cast to the table's own types."""
    target = spark.table(table)
    rows = aligned(read_csv(spark, source, T.StructType([
        T.StructField(f.name, T.StringType()) for f in target.schema
    ])), target)
    rows.write.insertInto(table)
    return spark.table(table)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
