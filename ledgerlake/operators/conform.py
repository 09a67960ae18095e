"""Bronze to Silver: newest version, quality rules, derived value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.functions.columns import with_trade_value

# Orders versions that carry the same modification time; together with the key
# these are all business columns, so rows that still tie are exact copies.
BLOTTER_TIES = ("trade_date", "security_id", "trader_id", "trade_type", "quantity", "price")


def trade_rules() -> dict[str, Column]:
    """The blotter's quality rules, by the column they guard."""
    return {"quantity": F.col("quantity") > 0, "price": F.col("price") > 0}


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], ties: Sequence[str]
) -> DataFrame:
    """Keep the newest row of every key.

    ``ties`` decides between rows equal in ``newest`` and is required: without it
    the kept row would depend on how the data was split. The filter right above
    ``row_number`` lets Spark cut each map task to one row per key before the
    shuffle, so the copies of one hot key never meet in a single task.
    """
    order = [F.col(c).desc_nulls_last() for c in (*newest, *ties)]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Collapse exact copies; they merge map-side before the shuffle."""
    return df.distinct()


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected). A rule that is false or unknown rejects the row.

    Rejected rows carry the first broken rule as ``reason``; good and rejected
    together are the input.
    """
    passes = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    good = df.where(reduce(Column.__and__, rules.values()))
    broken = F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in passes.items()])
    rejected = df.withColumn("reason", broken).where(F.col("reason").isNotNull())
    return good, rejected


def newest_trades(bronze: DataFrame) -> DataFrame:
    return latest_per_key(bronze, ["trade_id"], ["last_modified_ts"], BLOTTER_TIES)


def silver_trades(bronze: DataFrame) -> DataFrame:
    """Newest version first, then the rules: a bad newest version hides older good ones."""
    good, _ = split_valid(newest_trades(bronze), trade_rules())
    return with_trade_value(good).drop("last_modified_ts")


def rejected_trades(bronze: DataFrame) -> DataFrame:
    return split_valid(newest_trades(bronze), trade_rules())[1]
