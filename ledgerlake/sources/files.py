"""File sources. Schemas are declared; inference is an option."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: How CSV files are read: by header names, cells as they are, an empty quoted cell as
#: empty text and an unquoted one as NULL, stamps with a blank or a T and up to nine digits.
CSV_READ = {
    "header": True,
    "escape": '"',
    "enforceSchema": False,
    "nullValue": "\x00",
    "timestampNTZFormat": "yyyy-MM-dd[' ']['T']HH:mm:ss[.SSSSSSSSS]",
}


def read_csv(
    spark: SparkSession,
    path,
    schema: T.StructType | None = None,
    corrupt: str | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the files twice to guess one.

    A header that names other columns than the schema, or in another order, is an error.
    ``corrupt`` names a column that keeps the text of lines that do not fit the schema.
    Quoted cells may hold line breaks; files known to have none can be split among tasks
    with ``line_breaks=False``.
    """
    reader = spark.read.options(**CSV_READ).option("multiLine", line_breaks)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt:
        schema = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_create(
    spark: SparkSession, path: str, schema: T.StructType, *partitions: str
) -> DataFrame:
    """The Parquet table at a path, created empty when nothing was written there yet."""
    empty = spark.createDataFrame([], schema).write.mode("ignore")
    (empty.partitionBy(*partitions) if partitions else empty).parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_window(spark: SparkSession, root: str, window_date) -> DataFrame:
    """One day of a table stored by window_date, from that day's folder alone.

    A day that was never stored has no rows; only then are the other folders listed.
    """
    day = F.lit(window_date).cast("date")
    reader = spark.read.option("basePath", root)
    try:
        rows = reader.parquet(f"{root}/window_date={window_date}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.read.parquet(root)
    return rows.where(F.col("window_date") == day)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path, name, size and modification time of each file below a folder, without content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size"),
        "modificationTime",
    )


def require_input(spark: SparkSession, path: str) -> DataFrame:
    """The inventory of an input folder; raises when there is nothing to load."""
    try:
        found = file_inventory(spark, path)
        missing = found.isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        missing = True
    if missing:
        raise FileNotFoundError(f"no input files at {path}")
    return found


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All CSV files of a landing folder in one scan, each row with its file's name and size."""
    require_input(spark, path)
    rows = read_csv(spark, path, schema)
    return rows.select(
        *schema.names,
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_size").alias("_file_size"),
    )


def landed_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The inventory of a landing folder with each CSV file's number of rows, 0 included."""
    files = require_input(spark, path)
    counts = (
        read_csv(spark, path, schema)
        .groupBy(F.col("_metadata.file_path").alias("of_path"))
        .agg(F.count("*").alias("row_count"))
    )
    # one source may show a local path as file:/x and another as file:///x
    same = F.regexp_replace("path", "^file:/+", "/") == F.regexp_replace("of_path", "^file:/+", "/")
    return files.join(counts, same, "left").drop("of_path").fillna(0, "row_count")


def snapshot_path(root: str, name: str, snapshot_date: date | str) -> str:
    """``<root>/<name>_<yyyymmdd>.csv``"""
    return f"{root}/{name}_{str(snapshot_date).replace('-', '')}.csv"


def read_snapshot(
    spark: SparkSession, root: str, name: str, snapshot_date, schema: T.StructType
) -> DataFrame:
    """The snapshot file of one date, without its snapshot_date column."""
    return read_csv(spark, snapshot_path(root, name, snapshot_date), schema).drop("snapshot_date")


def extract_window(df: DataFrame, window_date, columns, date_column: str) -> DataFrame:
    """Chosen columns of one day; the filter and the column list reach the scan."""
    return df.where(F.col(date_column) == F.lit(window_date).cast("date")).select(*columns)


def jdbc_window(
    spark: SparkSession,
    url: str,
    table: str,
    window_date,
    columns,
    date_column: str,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """The same extract from a database, filtered there.

    ``split`` is (numeric column, lowest, highest, number of parts) for parallel reads.
    Not exercised in this repository: it needs a running database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split:
        column, low, high, parts = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", parts)
        )
    return extract_window(reader.options(**options).load(), window_date, columns, date_column)
