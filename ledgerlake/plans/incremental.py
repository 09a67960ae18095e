"""Loads that carry Gold along: what an upsert changes in Silver changes Gold by as much."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.gold import total_of
from ledgerlake.operators.upsert import (
    in_partitions,
    touched_partitions,
    upsert_changes,
    upsert_partitions,
)
from ledgerlake.plans.windows import UPDATED, backfill
from ledgerlake.schemas import SILVER, TOTAL, TRADES
from ledgerlake.sinks.tables import is_complete, write_parquet, write_partitioned
from ledgerlake.sources.files import read_or_create

GOLD_KEYS = ["trade_date", "trader_id", "trade_type"]
GOLD = T.StructType(
    [
        T.StructField("trade_date", T.DateType()),
        T.StructField("trader_id", T.LongType()),
        T.StructField("trade_type", T.StringType()),
        T.StructField("total_trade_value", TOTAL),
        T.StructField("trade_count", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("part", T.DateType()),
    ]
)
STORED_SILVER = T.StructType([*SILVER, T.StructField("part", T.DateType())])


def gold_delta(changes: DataFrame) -> DataFrame:
    """By how much each Gold group changes; groups that end as they were are left out."""
    sums = changes.groupBy(*GOLD_KEYS, "part").agg(
        total_of(F.col("sign") * F.col("trade_value")).alias("total_trade_value"),
        F.sum("sign").cast("long").alias("trade_count"),
    )
    return sums.where((F.coalesce("total_trade_value", F.lit(0)) != 0) | (F.col("trade_count") != 0))


def apply_delta(spark: SparkSession, path: str, delta: DataFrame, run: str) -> list:
    """Add a delta to the Gold table at ``path``; only the folders it names are rewritten.

    Every row of a rewritten folder carries the run that wrote it, and a folder that carries
    this run is passed over. So a run that stopped half-way may be repeated: each folder
    gets the delta once. Groups left without a trade stay as rows of zero, which
    ``read_gold`` hides. Returns the folders rewritten.
    """
    held = read_or_create(spark, path, GOLD, "part")
    parts = [r[0] for r in delta.select("part").distinct().collect()]  # touched folders
    there = in_partitions(held, "part", parts)
    done = {r[0] for r in there.where(F.col("run") == run).select("part").distinct().collect()}
    parts = [d for d in parts if d not in done]
    if parts:
        rows = in_partitions(held, "part", parts).drop("run")
        rows = rows.unionByName(in_partitions(delta, "part", parts))
        merged = rows.groupBy(*GOLD_KEYS, "part").agg(
            total_of("total_trade_value").alias("total_trade_value"),
            F.sum("trade_count").cast("long").alias("trade_count"),
        )
        write_partitioned(merged.withColumn("run", F.lit(run)), path, "part")
    return parts


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_or_create(spark, path, GOLD, "part").where("trade_count > 0").drop("run", "part")


def load_days(
    spark: SparkSession,
    bronze: DataFrame,
    lake: str,
    dates: Iterable,
    now,
    run: str,
    grain: str = "day",
) -> dict:
    """Load some days of Bronze into Silver by upsert, and into Gold by the difference.

    ``run`` names the load; a load that stopped is repeated under the same name. The
    difference is stored before Silver is touched, so a repeated load still knows it:
    it is not computed again, the upsert writes the same rows, and Gold takes it once.
    Cost follows the folders touched, not the size of Silver or Gold; a folder holds a
    ``day``, or a ``month`` where days are small.
    """
    days = sorted({date.fromisoformat(str(d)) for d in dates})
    rows = bronze.where(F.col("trade_date").isin(days)).select(*TRADES.names)
    part = F.trunc("trade_date", "month") if grain == "month" else F.col("trade_date")
    loaded = backfill(rows, now).withColumn("part", part).select(*STORED_SILVER.names).persist()

    silver, difference = f"{lake}/silver_table/trades", f"{lake}/gold_deltas/{run}"
    try:
        target = read_or_create(spark, silver, STORED_SILVER, "part")
        touched = touched_partitions(target, loaded, ["trade_id"], "part")
        if not is_complete(spark, difference):
            there = in_partitions(target, "part", touched)
            changes = upsert_changes(there, loaded, ["trade_id"], UPDATED)
            write_parquet(gold_delta(changes), difference)
        upsert_partitions(spark, silver, loaded, ["trade_id"], UPDATED, "part", touched)
    finally:
        loaded.unpersist()
    written = apply_delta(spark, f"{lake}/gold/daily", spark.read.parquet(difference), run)
    return {"run": run, "silver_folders": len(touched), "gold_folders": len(written)}
