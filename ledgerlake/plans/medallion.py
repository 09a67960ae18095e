"""The whole path for one run: Bronze, checked Silver, checked Gold, and history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.operators.conform import silver_trades
from ledgerlake.operators.gold import gold_daily
from ledgerlake.operators.history import scd2_apply, scd2_init
from ledgerlake.operators.quality import (
    blotter_suite,
    gate,
    refuse_failed,
    watched,
    watched_results,
)
from ledgerlake.sinks.tables import (
    changed_versions,
    show_version,
    write_history,
    write_version,
)
from ledgerlake.sources.files import read_or_create, read_parquet

HISTORY_FIELDS = (
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
)


@dataclass
class Build:
    """Stored layers of a run and the results of their checks."""

    silver: DataFrame
    gold: DataFrame
    traders: DataFrame
    history: DataFrame
    checks: list


def build(
    spark: SparkSession,
    bronze: DataFrame,
    traders: DataFrame,
    lake: str,
    batch_date,
    prefix: str = "blotter",
) -> Build:
    """Build, check and publish each layer; history only grows.

    A layer is written to a folder of its own, where its row checks are counted by the
    write itself. Only if no check of severity ``error`` failed does the layer's view
    (``prefix`` and its name) move to that folder; otherwise the run stops, and the view
    keeps showing the layer before. Bronze stays a view of its source.
    """
    checks = []
    suite = blotter_suite()

    def of(table: str) -> list:
        return [c for c in suite if c.table == table]

    def layered(df: DataFrame, name: str, with_tables: dict | None = None) -> DataFrame:
        rows, seen = watched(df, of(name))
        folder = write_version(rows, f"{lake}/{name}")
        stored = read_parquet(spark, folder)
        results = watched_results(seen, of(name), {name: stored, **(with_tables or {})})
        checks.extend(results)
        refuse_failed(results)
        return show_version(spark, folder, f"{prefix}_{name}")

    # Bronze is read once: its rows are counted on their way into Silver
    rows, seen = watched(bronze, of("bronze_trades"))
    checks.extend(gate({"dim_trader": traders}, of("dim_trader")))
    silver = layered(silver_trades(rows), "silver_trades")
    results = watched_results(seen, of("bronze_trades"), {"bronze_trades": bronze})
    checks.extend(results)
    refuse_failed(results)
    dim = layered(traders, "gold_dim_trader")
    gold = layered(gold_daily(silver), "gold_fact_trades_daily", {"gold_dim_trader": dim})

    path = f"{lake}/gold_dim_trader_scd2"
    schema = T.StructType([*dim.schema, *HISTORY_FIELDS])
    before = read_or_create(spark, path, schema, "valid_to")
    if before.isEmpty():
        write_history(scd2_init(dim, batch_date), path)
    else:
        compare = [c for c in dim.columns if c not in ("trader_id", "trader_name")]
        after = scd2_apply(before, dim, "trader_id", compare, batch_date)
        write_history(changed_versions(after, batch_date), path)
    history = spark.read.schema(schema).parquet(path)
    return Build(silver, gold, dim, history, checks)
