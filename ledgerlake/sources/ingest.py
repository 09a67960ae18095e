"""CSV parsed once into good rows and rejects, for batches and streams alike.

Cells are read as text, so nothing is lost on the way: a row is good if every cell fits
its column, otherwise it is a reject with its file, its cells and the reason. Good rows
and rejects together are the lines of the files, headers left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.files import CSV_READ, require_input

LINE, FILE = "_line", "_file"
REJECTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("file", "line", "reason")]
)


def cells_schema(schema: T.StructType) -> T.StructType:
    """The columns as text, and the text of lines that hold fewer or more cells."""
    texts = [T.StructField(f.name, T.StringType()) for f in schema]
    return T.StructType([*texts, T.StructField(LINE, T.StringType())])


CELLS_READ = {
    **{k: v for k, v in CSV_READ.items() if k not in ("header", "enforceSchema")},
    "header": False,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": LINE,
    "multiLine": True,
}


def with_file(cells: DataFrame) -> DataFrame:
    return cells.select("*", F.col("_metadata.file_path").alias(FILE))


def read_cells(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Every line of CSV files, headers included, as text cells with their file."""
    return with_file(spark.read.options(**CELLS_READ).schema(cells_schema(schema)).csv(path))


def typed(cell: Column, kind: T.DataType) -> Column:
    """A text cell in its column's type, NULL if it does not fit; text is kept as it is."""
    return cell if isinstance(kind, T.StringType) else F.trim(cell).try_cast(kind)


def is_header(schema: T.StructType) -> Column:
    return F.col(LINE).isNull() & F.concat_ws("\x00", *schema.names).eqNullSafe(
        F.lit("\x00".join(schema.names))
    )


def sorted_out(
    cells: DataFrame, schema: T.StructType, required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of text cells. Lines that repeat the header are neither.

    The reason names the first cell that does not fit; ``required`` cells may not be
    missing. An unquoted empty cell is a missing one in every column but text.
    """
    reasons = [F.when(F.col(LINE).isNotNull(), "wrong number of cells")]
    for f in schema:
        cell = F.col(f.name)
        unfit = typed(cell, f.dataType).isNull() & (F.trim(cell) != "")
        reasons.append(F.when(unfit, f"{f.name} is not of type {f.dataType.simpleString()}"))
        if f.name in required:
            reasons.append(F.when(cell.isNull() | (F.trim(cell) == ""), f"{f.name} is missing"))
    told = cells.where(~is_header(schema)).withColumn("_reason", F.coalesce(*reasons))
    good = told.where(F.col("_reason").isNull()).select(
        *(typed(F.col(f.name), f.dataType).alias(f.name) for f in schema), FILE
    )
    line = F.coalesce(F.col(LINE), F.to_csv(F.struct(*schema.names)))
    rejects = told.where(F.col("_reason").isNotNull()).select(
        F.col(FILE).alias("file"), line.alias("line"), F.col("_reason").alias("reason")
    )
    return good, rejects


def read_two_ways(
    spark: SparkSession,
    path,
    schema: T.StructType,
    required: Sequence[str] = (),
    check_headers: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of CSV files. A file without the declared header is rejected whole,
    its lines with the reason ``wrong header``; that costs a pass over the files' lines and
    can be left out for a trusted feed."""
    cells = read_cells(spark, path, schema)
    if not check_headers:
        return sorted_out(cells, schema, required)
    headed = cells.groupBy(FILE).agg(F.bool_or(is_header(schema)).alias("_headed"))
    cells = cells.join(headed, FILE)
    good, rejects = sorted_out(cells.where("_headed"), schema, required)
    line = F.coalesce(F.col(LINE), F.to_csv(F.struct(*schema.names)))
    whole = cells.where("not _headed").select(
        F.col(FILE).alias("file"), line.alias("line"), F.lit("wrong header").alias("reason")
    )
    return good, rejects.unionByName(whole)


def read_landing_two_ways(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """A landing folder in one scan; raises when there is nothing to load."""
    require_input(spark, path)
    return read_two_ways(spark, path, schema, required)


def read_snapshots(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType,
    required: Sequence[str] = (),
    date: str = "snapshot_date",
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of every ``<root>/<name>_<yyyymmdd>.csv``, as one series.

    The date comes from the file's name and stands in column ``date``, whatever the file
    says there itself. Files whose name holds no date are rejected line by line. The good
    rows of all files are one DataFrame, ready for ``history.scd2_from_snapshots``.
    """
    good, rejects = read_two_ways(spark, f"{root}/{name}_*.csv", schema, required)
    in_name = F.regexp_extract(FILE, r"_([0-9]{8})\.csv(/|$)", 1)  # a file or a folder
    named = F.to_date(F.when(in_name != "", in_name), "yyyyMMdd")
    good = good.withColumn(date, named)
    others = [c for c in good.columns if c not in (FILE, date)]
    undated = good.where(F.col(date).isNull()).select(
        F.col(FILE).alias("file"),
        F.to_csv(F.struct(*others)).alias("line"),
        F.lit("no date in the file's name").alias("reason"),
    )
    return good.where(F.col(date).isNotNull()).drop(FILE), rejects.unionByName(undated)
