"""Arrivals with state: each row once within a watermark, late and bad lines kept aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.sources.files import read_or_create
from ledgerlake.sources.ingest import CELLS_READ, FILE, REJECTS, cells_schema, sorted_out, with_file
from ledgerlake.streaming.arrivals import with_fingerprint


def _write(df: DataFrame, path: str, batch_id: int, *folders: str) -> None:
    """The batch's own folder, replaced when the batch is tried again."""
    (
        df.withColumn("batch", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch", *folders)
        .parquet(path)
    )


def _stored(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    more = [("row_digest", T.BinaryType()), ("row_day", T.DateType()), ("batch", T.LongType())]
    kept = T.StructType([*schema, *(T.StructField(name, kind) for name, kind in more)])
    return read_or_create(spark, f"{out}/rows", kept, "batch", "row_day")


def _like(df: DataFrame, schema: T.StructType, kind: str) -> DataFrame:
    """The rows in one common shape, marked with what they are."""
    cells = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(F.lit(kind).alias("_kind"), *cells)


def ingest_once(
    spark: SparkSession,
    in_dir: str,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    event_time: str,
    delay: str = "2 days",
    required: tuple[str, ...] = (),
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load every CSV file that has arrived since the last run, then stop.

    Lines that do not fit go to ``out/rejects`` with file and reason. Good rows pass
    Spark's ``dropDuplicatesWithinWatermark`` on a digest of the row: its state holds the
    digests of the last ``delay`` of event time and no more, and survives restarts. Rows
    it lets through go to ``out/rows``, split by day. Of the others, those stored before
    are copies; rows behind the watermark that are not stored are late, and rejects too.
    Only for such rows is ``out/rows`` read back, and only the days they name.

    Every batch writes its own folders, so a batch that is tried again replaces what it
    wrote. ``event_time`` names a column of a time type; a row without it is a reject.
    """
    reader = (
        spark.readStream.schema(cells_schema(schema))
        .options(**CELLS_READ)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    cells = with_file(reader.csv(in_dir))
    good, rejects = sorted_out(cells, schema, (*required, event_time))
    day = F.col(event_time).cast("date").alias("row_day")
    marked = with_fingerprint(good, schema.names)
    passed = (
        marked.withColumn("_at", F.col(event_time).cast("timestamp"))
        .withWatermark("_at", delay)
        .dropDuplicatesWithinWatermark(["row_digest"])
        .select(*schema.names, "row_digest", day)
    )
    line = F.to_csv(F.struct(*schema.names)).alias("line")
    seen = marked.select("row_digest", day, F.col(FILE).alias("file"), line)
    common = T.StructType([*passed.schema, *REJECTS])
    # one source feeds all three, so a batch holds the same lines in each
    everything = (
        _like(passed, common, "passed")
        .union(_like(seen, common, "seen"))
        .union(_like(rejects, common, "reject"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            new = batch.where("_kind = 'passed'").select(*passed.columns)
            _write(new, f"{out}/rows", batch_id, "row_day")
            rest = batch.where("_kind = 'seen'").join(new, "row_digest", "left_anti")
            days = [r[0] for r in rest.select("row_day").distinct().collect()]
            held = _stored(batch.sparkSession, out, schema)
            known = held.where(F.col("row_day").isin(days)).select("row_digest")
            late = rest.join(known, "row_digest", "left_anti")
            late = late.select("file", "line", F.lit("late").alias("reason"))
            told = batch.where("_kind = 'reject'").select(*REJECTS.names)
            _write(told.unionByName(late), f"{out}/rejects", batch_id)
        finally:
            batch.unpersist()

    return (
        everything.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The rows loaded so far."""
    return _stored(spark, out, schema).select(*schema.names)


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    """The lines set aside so far: file, line, reason."""
    kept = T.StructType([*REJECTS, T.StructField("batch", T.LongType())])
    return read_or_create(spark, f"{out}/rejects", kept, "batch").select(*REJECTS.names)
