"""Writes: folders, daily windows, managed tables, views."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.columns import END_OF_TIME


def write_parquet(df: DataFrame, path: str, codec: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder was committed."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def land(df: DataFrame, source: str, path: str) -> None:
    """Copy rows as they arrived into Parquet, never over the folder they come from."""
    if path.rstrip("/") == source.rstrip("/"):
        raise ValueError("a landing folder cannot be overwritten by its own copy")
    write_parquet(df, path)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )


def write_partitioned(df: DataFrame, path: str, *columns: str, codec: str = "snappy") -> None:
    """One folder per value; only the folders present in ``df`` are replaced.

    The rebalance brings a folder's rows together, and lets Spark split one that is
    far larger than the others over several tasks.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .partitionBy(*columns)
        .parquet(path)
    )


def write_keyed(df: DataFrame, path: str, partition: str, key: str) -> None:
    """As ``write_partitioned``, with each folder's rows in key order and a Bloom filter on
    the key in every row group, so that a later look for a few keys skips most of them."""
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")  # as large as the keys need
        .partitionBy(partition)
        .parquet(path)
    )


def write_window(df: DataFrame, root: str, window_date) -> None:
    """Store one day's rows in its own folder; a rerun replaces that day only."""
    write_partitioned(
        df.withColumn("window_date", F.lit(window_date).cast("date")), root, "window_date"
    )


def write_load_date(df: DataFrame, path: str, load_date=None) -> None:
    """Partition by the date the rows were loaded."""
    loaded = F.lit(load_date).cast("date") if load_date is not None else F.current_date()
    write_partitioned(df.withColumn("LoadDate", loaded), path, "LoadDate")


def write_clustered(df: DataFrame, path: str, n: int, *keys: str) -> None:
    """About n files with a key's rows together; oversized keys are split, not piled up."""
    df.hint("rebalance", n, *keys).write.mode("overwrite").parquet(path)


def write_history(history: DataFrame, path: str) -> None:
    """Store a versioned table by the end of validity.

    All versions one batch ends share a folder, and the current ones are the folder of
    END_OF_TIME. Pass only what a batch changed (the versions it ended and all current
    ones): those two folders are replaced, older ones are not read or written, and
    running the batch again writes the same two folders.
    """
    write_partitioned(history, path, "valid_to")


def changed_versions(history: DataFrame, batch_date) -> DataFrame:
    """What a batch wrote: the versions it ended and all current ones."""
    ended = F.date_sub(F.lit(batch_date).cast("date"), 1)
    return history.where(F.col("valid_to").isin(ended, F.lit(END_OF_TIME).cast("date")))


def restored(spark: SparkSession, table: str) -> None:
    """Undo a publication that stopped between its two renames: put the old table back."""
    previous = f"{table}__previous"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(previous):
        spark.sql(f"ALTER TABLE {previous} RENAME TO {table}")


def publish(spark: SparkSession, df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a table that ``df`` may itself read.

    The rows are written to a second table first and renamed into place, so a failed
    write leaves the old table as it was. The two renames are not one atomic step; if a
    run stops between them, the next ``publish`` or ``read_or_init`` puts the old table back.
    With a ``path`` every publication gets its own folder below it, and the files of
    earlier ones stay there.
    """
    staged, previous = f"{table}__next", f"{table}__previous"
    restored(spark, table)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", f"{path}/{uuid.uuid4().hex}")
    writer.saveAsTable(staged)
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def publish_version(
    spark: SparkSession, df: DataFrame, name: str, root: str, **properties: str
) -> DataFrame:
    """Replace what a catalog view shows, in one step.

    The rows go to a folder of their own below ``root``; one statement then points the
    view at it. A reader finds the old rows or the new ones, never none, a run that stops
    before that statement changes nothing, and ``df`` may read the view itself.
    ``properties`` are stored with the view in the same statement.
    """
    return show_version(spark, write_version(df, root), name, **properties)


def write_version(df: DataFrame, root: str) -> str:
    """The rows in a new folder below ``root``, which nothing shows yet."""
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    write_parquet(df, folder)
    return folder


def quoted(name: str) -> str:
    """A table name, its parts in backquotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def show_version(spark: SparkSession, folder: str, name: str, **properties: str) -> DataFrame:
    """Point the view at a stored folder."""
    marks = ", ".join(
        "'{}' = '{}'".format(k, str(v).replace("\\", "\\\\").replace("'", "\\'"))
        for k, v in properties.items()
    )
    stored = f"TBLPROPERTIES ({marks})" if marks else ""
    place = folder.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} {stored} AS SELECT * FROM parquet.`{place}`")
    return spark.table(name)


def version_property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property stored with the version shown now."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").where(F.col("key") == key).collect()
    return rows[0]["value"] if rows else None


def write_bucketed(
    df: DataFrame, name: str, n: int, *keys: str, path: str | None = None
) -> DataFrame:
    """A table in n buckets by key, each in key order: joins and groups by the key, and
    between tables of equal buckets, need no shuffle.

    Rows are brought to their bucket first, so a bucket is one file and not one per task.
    """
    writer = (
        df.repartition(n, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(n, *keys)
        .sortBy(*keys)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def materialize(
    spark: SparkSession, df: DataFrame, name: str, kind: str, path: str | None = None
) -> DataFrame:
    """Expose a layer as a ``view``, computed when read, or a ``table``, stored once."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        publish(spark, df, name, path)
    else:
        raise ValueError(f"unknown kind {kind}")
    return spark.table(name)


def store_failures(spark: SparkSession, failing: DataFrame, table: str, path=None) -> DataFrame:
    """Keep the rows that failed a check, for inspection."""
    return materialize(spark, failing, table, "table", path)


def partition_values(spark: SparkSession, path: str, column: str) -> Sequence:
    """Distinct values of a partition column."""
    return [r[0] for r in spark.read.parquet(path).select(column).distinct().collect()]
