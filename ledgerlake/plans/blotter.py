"""The trade blotter seen in the given tables.

Order lines are trades, parts are securities, suppliers are traders with a nation as
desk. A line number repeats within an order, so trades arrive in several versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.operators.conform import (
    BLOTTER_TIES,
    latest_per_key,
    silver_trades,
    split_valid,
    trade_rules,
)
from ledgerlake.functions.columns import with_trade_value
from ledgerlake.operators.gold import gold_daily

# fixed values: dates of the first load and of the two trader snapshots
LOAD_DATE, FIRST_BATCH, SECOND_BATCH = "1995-01-01", "1998-01-01", "2000-01-01"
AMENDMENT_DATE = "2002-01-01"
REVIEW_LIMIT = 30000


class Blotter:
    """DataFrames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def bronze(self) -> DataFrame:
        """All versions of all trades. Some returns are booked with a negative quantity
        and some lines without a price, the bad input the quality rules look for."""
        sold_back = (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.095)
        unpriced = (
            (F.col("l_returnflag") == "A")
            & (F.col("l_tax") >= 0.075)
            & (F.col("l_discount") < 0.005)
        )
        orders = self.table("orders").select(
            "o_orderkey", F.col("o_orderdate").cast("date").alias("trade_date")
        )
        prices = self.table("part").select(
            "p_partkey", F.col("p_retailprice").cast("decimal(18,4)").alias("list_price")
        )
        return (
            self.table("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(prices, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
                "trade_date",
                F.col("l_partkey").alias("security_id"),
                F.col("l_suppkey").alias("trader_id"),
                F.when(F.col("l_linestatus") == "F", "BUY").otherwise("SELL").alias("trade_type"),
                F.when(sold_back, -F.col("l_quantity"))
                .otherwise(F.col("l_quantity"))
                .cast("decimal(18,2)")
                .alias("quantity"),
                F.when(unpriced, F.lit(0).cast("decimal(18,4)"))
                .otherwise(F.col("list_price"))
                .alias("price"),
                F.col("l_shipdate").alias("last_modified_ts"),
            )
        )

    def silver(self) -> DataFrame:
        return silver_trades(self.bronze())

    def gold(self) -> DataFrame:
        return gold_daily(self.silver())

    def securities(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("security_id"),
            F.concat(F.lit("P"), F.col("p_partkey")).alias("ticker"),
            F.col("p_name").alias("security_name"),
            F.col("p_type").alias("asset_class"),
            F.col("p_brand").alias("sector"),
        )

    def _suppliers(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def traders(self) -> DataFrame:
        return self._traders(self._suppliers(), F.col("n_name"), F.col("r_name"))

    @staticmethod
    def _traders(suppliers: DataFrame, desk, region) -> DataFrame:
        return suppliers.select(
            F.col("s_suppkey").alias("trader_id"),
            F.col("s_name").alias("trader_name"),
            desk.alias("desk"),
            region.alias("region"),
        )

    def first_traders(self) -> DataFrame:
        """The first load: without those who join later, some not yet given a desk."""
        balance = F.col("s_acctbal")
        known = self._suppliers().where((balance < 4000) | (balance >= 5500))
        waiting = (balance >= 1000) & (balance < 1200)
        return self._traders(known, F.when(~waiting, F.col("n_name")), F.col("r_name"))

    def trader_batches(self) -> list[tuple[str, DataFrame]]:
        """Two dated snapshots: traders change desk or region, join, and one leaves out some."""
        balance, everyone = F.col("s_acctbal"), self._suppliers()

        def states(rows, workout_below, global_from):
            return self._traders(
                rows,
                F.when(balance < workout_below, "WORKOUT").otherwise(F.col("n_name")),
                F.when(balance >= global_from, "GLOBAL").otherwise(F.col("r_name")),
            )

        first = everyone.where(
            ((balance < 5000) | (balance >= 5500)) & ((balance < 7000) | (balance >= 7200))
        )
        return [
            (FIRST_BATCH, states(first, 0, 9000)),
            (SECOND_BATCH, states(everyone, -500, 8000)),
        ]

    def logins(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("trader_id"),
            F.concat(F.lit("user"), F.col("s_suppkey"), F.lit("@example.com")).alias("login_name"),
        )

    def _ends(self, oldest: bool, n: int) -> DataFrame:
        """Up to n versions of every trade from one end of its history, numbered.

        Each map task keeps n rows per trade before the shuffle.
        """
        order = [F.col(c) for c in ("last_modified_ts", *BLOTTER_TIES)]
        order = [c.asc_nulls_first() if oldest else c.desc_nulls_last() for c in order]
        number = F.row_number().over(W.partitionBy("trade_id").orderBy(*order))
        return self.bronze().withColumn("version", number).where(F.col("version") <= n)

    @staticmethod
    def _valid(versions: DataFrame) -> DataFrame:
        return split_valid(versions.select("trade_id", *BLOTTER_TIES), trade_rules())[0]

    def first_book(self) -> DataFrame:
        """Trades as first booked: the oldest version, if it is valid."""
        return with_trade_value(self._valid(self._ends(oldest=True, n=1)))

    def amendments(self) -> DataFrame:
        """The newest version of every trade that has more than one, as a correction."""
        ends = self._ends(oldest=False, n=2)
        found = F.max("version").over(W.partitionBy("trade_id"))
        newest = ends.withColumn("found", found).where("version = 1 and found > 1")
        return self._valid(newest).withColumn(
            "amendment_reason", F.lit("correction after confirmation")
        ).withColumn("amendment_date", F.lit(AMENDMENT_DATE).cast("date"))

    def user_days(self) -> DataFrame:
        """Daily snapshots of users: the last event of each user and day."""
        events = self.table("events").withColumn("day", F.col("ts").cast("date"))
        last = latest_per_key(events, ["user_id", "day"], ["ts"], ["event_id"])
        return last.select("user_id", F.col("event_type").alias("state"), "day")
