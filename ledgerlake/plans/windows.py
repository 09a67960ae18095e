"""Daily window loads: extract, Bronze, Silver, and the summary of a run."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.functions.columns import with_audit, with_trade_value
from ledgerlake.operators.conform import (
    BLOTTER_TIES,
    latest_per_key,
    silver_trades,
    split_valid,
    trade_rules,
)
from ledgerlake.operators.upsert import upsert_partitions
from ledgerlake.schemas import SILVER, TRADES
from ledgerlake.sinks.tables import write_partitioned, write_window
from ledgerlake.sources.files import extract_window, read_or_create, read_window

UPDATED = ("quantity", "price", "trade_value", "silver_loaded_ts")


def transform_window(
    spark: SparkSession, bronze: DataFrame, silver_path: str, window_date, now
) -> dict:
    """Conform one day of Bronze and upsert it into Silver; returns the summary row.

    A known trade takes the new quantity, price, value and load time and keeps its other
    columns.
    """
    day_rows = extract_window(bronze, window_date, TRADES.names, "trade_date")
    loaded = with_audit(silver_trades(day_rows), now)
    upsert_partitions(spark, silver_path, loaded, ["trade_id"], UPDATED, "trade_date")
    stored = spark.read.schema(SILVER).parquet(silver_path)
    return {
        "window_date": str(window_date),
        "bronze_row_count": day_rows.select("trade_id").count(),
        "silver_row_count": extract_window(
            stored, window_date, ["trade_id"], "trade_date"
        ).count(),
    }


def pipeline_window(
    spark: SparkSession, source: DataFrame, lake: str, window_date, now
) -> dict:
    """Extract a day to Bronze, transform it, and copy the day's Silver rows to the lake."""
    write_window(
        extract_window(source, window_date, TRADES.names, "trade_date"),
        f"{lake}/bronze/trades",
        window_date,
    )
    bronze = read_window(spark, f"{lake}/bronze/trades", window_date)
    summary = transform_window(spark, bronze, f"{lake}/silver_table/trades", window_date, now)
    silver = spark.read.schema(SILVER).parquet(f"{lake}/silver_table/trades")
    write_window(
        extract_window(silver, window_date, SILVER.names, "trade_date"),
        f"{lake}/silver/trades",
        window_date,
    )
    return summary


def run_windows(
    spark: SparkSession, source: DataFrame, lake: str, dates: Iterable, now
) -> list[dict]:
    """Run the pipeline for each date in turn; rerunning a date replaces that date."""
    return [pipeline_window(spark, source, lake, d, now) for d in sorted(dates, key=str)]


def load_windows(
    spark: SparkSession, source: DataFrame, lake: str, dates: Iterable, now
) -> DataFrame:
    """Run the pipeline for several dates at once; returns one summary row per date.

    Bronze, Silver and the lake's copy are each written once, and Silver's keys are read
    once, however many dates there are. Silver ends as ``run_windows`` would leave it; the
    lake's copy shows each day as it stands after the last of the dates.
    """
    days = sorted({date.fromisoformat(str(d)) for d in dates})
    wanted = F.col("trade_date").isin(days)
    rows = source.where(wanted).select(*TRADES.names)
    write_partitioned(
        rows.withColumn("window_date", F.col("trade_date")), f"{lake}/bronze/trades", "window_date"
    )
    bronze = spark.read.parquet(f"{lake}/bronze/trades").where(F.col("window_date").isin(days))
    loaded = backfill(bronze, now).select(*SILVER.names)
    table = f"{lake}/silver_table/trades"
    # a first load meets no known trade: its rows lie in the folders of its dates
    first = read_or_create(spark, table, loaded.schema, "trade_date").isEmpty()
    upsert_partitions(
        spark, table, loaded, ["trade_id"], UPDATED, "trade_date", days if first else None
    )
    silver = spark.read.schema(SILVER).parquet(table).where(wanted)
    silver = silver.withColumn("window_date", F.col("trade_date"))
    write_partitioned(silver, f"{lake}/silver/trades", "window_date")

    summary = spark.createDataFrame([(d,) for d in days], "window_date date")
    for layer, df in (("bronze", bronze), ("silver", silver)):
        counts = df.groupBy("window_date").agg(F.count("*").alias(f"{layer}_row_count"))
        summary = summary.join(counts, "window_date", "left").fillna(0, f"{layer}_row_count")
    return summary.withColumn("window_date", F.col("window_date").cast("string"))


def backfill(bronze: DataFrame, now) -> DataFrame:
    """Silver after all windows of a Bronze table, in one pass instead of one run per day.

    Within a window the newest valid version counts. Across windows a trade keeps the
    identity its first window gave it and the amounts of its last.
    """
    newest = latest_per_key(
        bronze, ["trade_date", "trade_id"], ["last_modified_ts"], BLOTTER_TIES[1:]
    )
    good, _ = split_valid(newest, trade_rules())
    by_date = W.partitionBy("trade_id").orderBy("trade_date")
    first = by_date.rowsBetween(W.unboundedPreceding, 0)
    identity = ("trade_date", "security_id", "trader_id", "trade_type")
    merged = with_trade_value(good).withColumns(
        {
            "_last": F.lead(F.lit(1)).over(by_date).isNull(),
            **{c: F.first(c).over(first) for c in identity},
        }
    )
    amounts = ("quantity", "price", "trade_value")
    return with_audit(merged.where("_last").select("trade_id", *identity, *amounts), now)
