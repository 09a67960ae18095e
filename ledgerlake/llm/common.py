"""What the operators share: tables, stored intermediate results, words."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import work_folder

HOME = str(Path(__file__).resolve().parents[2])
#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    Later steps then read files that outlive any executor, join against a table whose
    size Spark knows, and never compute the rows a second time.
    """
    path = path or work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables of one step, given up together once their successor is stored.

    Nothing may read them afterwards: what a result still needs is stored elsewhere.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stored(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(work_folder(self.spark, purpose))
        return stored(df, purpose, self.paths[-1])

    def give_up(self) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self.paths.clear()


def python_workers(spark: SparkSession, rows: int = 1000) -> None:
    """Before a step in Python: bound its batches, and let its workers import this package.

    Long texts make Arrow's usual 10,000 rows more than a worker should hold. The
    package's folder matters where it is on the driver's path alone; a cluster where it
    is installed, or shipped with ``--py-files``, does not need it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > rows:
        spark.conf.set(name, str(rows))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])


def whole(text: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def fresh_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def digest_of(*cells: Column) -> Column:
    """Names a row by the values of some columns, nulls told apart from any text."""
    marked = []
    for cell in cells:
        cell = cell.cast("string")
        marked.append(
            F.coalesce(F.concat(F.length(cell).cast("string"), F.lit(":"), cell), F.lit("-"))
        )
    return F.unhex(F.sha2(F.concat(*marked), 256))


def with_digest(df: DataFrame, name: str) -> DataFrame:
    """The rows with a digest of all their columns, as ids may repeat or be missing."""
    return df.withColumn(name, digest_of(*(df[f"`{c}`"] for c in df.columns)))


def single_rows(df: DataFrame, digest: str) -> DataFrame:
    """One of each set of rows with the same digest.

    The filter sits directly above the window, so a map task sends one row per digest.
    """
    number = fresh_name(df, "number")
    inside = Window.partitionBy(digest).orderBy(digest)
    return df.withColumn(number, F.row_number().over(inside)).where(F.col(number) == 1).drop(number)


def hot_values(df: DataFrame, value: str, purpose: str, share: int = 1000, least: int = 64):
    """The values that more than one in ``share`` rows hold, and ``least`` rows or more.

    There are fewer than ``share`` of them whatever the input, so they may be broadcast.
    Returns (values, number of rows); counting merges repeats before the shuffle.
    """
    seen = Observation()
    counts = df.groupBy(value).count().observe(seen, F.sum("count").alias("rows"))
    often = stored(counts.where(F.col("count") >= least), purpose)
    rows = seen.get["rows"] or 0
    return often.where(F.col("count") * share > rows).select(value), rows
