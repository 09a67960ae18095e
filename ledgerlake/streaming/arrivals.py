"""Files that arrive in a folder, loaded once each and without duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.conform import distinct_rows
from ledgerlake.sources.files import CSV_READ, read_or_create


def with_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A digest of the row, or of some of its columns, so copies are found from one column of the target.

    Every cell enters in full, with its length before it; a missing one has its own mark.
    """

    def cell(name: str, kind: str):
        value = F.hex(F.col(name)) if kind == "binary" else F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    wanted = set(df.columns if columns is None else columns)
    row = F.concat_ws("|", *(cell(c, kind) for c, kind in df.dtypes if c in wanted))
    return df.withColumn("row_digest", F.unhex(F.sha2(row, 256)))


def append_new(
    spark: SparkSession, batch: DataFrame, path: str, load_date, day_column: str | None = None
) -> None:
    """Append the rows the target does not hold yet, below the folder of the load date.

    Copies inside the batch merge map-side first. Running the same batch again finds
    its rows in the target and adds nothing, so a retried batch is harmless.

    ``day_column`` names a date or time of the rows. Copies share it, so the target is
    also split by that day and only the days of the batch are read back; without it
    every batch is compared with the digests of the whole target.
    """
    fresh = with_fingerprint(distinct_rows(batch))
    folders = ["LoadDate"]
    if day_column:
        fresh = fresh.withColumn("row_day", F.col(day_column).cast("date"))
        folders.append("row_day")
    stored = T.StructType([*fresh.schema, T.StructField("LoadDate", T.DateType())])
    held = read_or_create(spark, path, stored, *folders)
    fresh = fresh.persist()
    try:
        if day_column:
            # at most one entry per day the batch holds
            days = [r[0] for r in fresh.select("row_day").distinct().collect()]
            undated = F.col("row_day").isNull() if None in days else F.lit(False)
            held = held.where(F.col("row_day").isin([d for d in days if d is not None]) | undated)
        new = fresh.join(held.select("row_digest"), "row_digest", "left_anti")
        loaded = F.lit(load_date).cast("date") if load_date is not None else F.current_date()
        (
            new.withColumn("LoadDate", loaded)
            .hint("rebalance", *folders)
            .write.mode("append")
            .partitionBy(*folders)
            .parquet(path)
        )
    finally:
        fresh.unpersist()


def ingest_stream(
    spark: SparkSession,
    in_dir: str,
    path: str,
    checkpoint: str,
    schema: T.StructType,
    load_date=None,
    files_per_batch: int | None = None,
    day_column: str | None = None,
) -> StreamingQuery:
    """Load every CSV file that has arrived since the last run, then stop.

    The checkpoint remembers which files are done. Across files exact copies are
    dropped by comparing with the target itself, so no state grows in the stream.
    """
    reader = (
        spark.readStream.schema(schema)
        .options(**CSV_READ)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, _batch_id: int) -> None:
        append_new(batch.sparkSession, batch, path, load_date, day_column)

    return (
        reader.csv(in_dir)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("row_digest", "row_day")
