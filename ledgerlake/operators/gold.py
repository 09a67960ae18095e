"""Gold aggregates. Every one is a partial then final aggregate with one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import average, in_month, percent, with_flag_over
from ledgerlake.operators.joins import BROADCAST_LIMIT, small, star_join

TOTAL = "decimal(28,2)"


def total_of(measure: str | Column) -> Column:
    return F.sum(measure).cast(TOTAL)


def totals(
    df: DataFrame,
    keys: Sequence[str],
    measure: str = "trade_value",
    total: str = "total_trade_value",
    n: str = "trade_count",
) -> DataFrame:
    """Sum of a measure and number of rows per group."""
    return df.groupBy(*keys).agg(total_of(measure).alias(total), F.count("*").alias(n))


def gold_daily(silver: DataFrame) -> DataFrame:
    """Grain: one row per trade date, trader and side."""
    return totals(silver, ["trade_date", "trader_id", "trade_type"])


def totals_through(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    keys: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Group a fact by attributes of a dimension: total value, rows and mean price.

    A small dimension is broadcast. Otherwise the fact is first summed per key, so a
    key holding much of the fact reaches the join as one row per other group column.
    ``how`` is ``left`` or ``inner``: only groups of the fact have totals.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"totals of a fact need a left or inner join, not {how}")
    sums = {
        "_value": F.sum("trade_value"),
        "_rows": F.count("*"),
        "_price": F.sum("price"),
        "_prices": F.count("price"),
    }
    if small(dim, limit):
        joined = star_join(fact, {key: F.broadcast(dim)}, how)
    else:
        own = [c for c in keys if c in fact.columns]
        parts = fact.groupBy(key, *own).agg(*[s.alias(n) for n, s in sums.items()])
        joined = star_join(parts, {key: dim}, how)
        sums = {n: F.sum(n) for n in sums}
    grouped = joined.groupBy(*keys).agg(*[s.alias(n) for n, s in sums.items()])
    return grouped.select(
        *keys,
        F.col("_value").cast(TOTAL).alias("total_trade_value"),
        F.col("_rows").cast("bigint").alias("trade_count"),
        average(F.col("_price"), F.col("_prices")).cast("decimal(18,2)").alias("avg_price"),
    )


def gold_by_asset(
    silver: DataFrame, securities: DataFrame, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Grain: one row per trade date, asset class and side."""
    dim = securities.select("security_id", "asset_class")
    return totals_through(
        silver, dim, "security_id", ["trade_date", "asset_class", "trade_type"], limit=limit
    )


def traded_value_by_month(
    fact: DataFrame,
    calendar: DataFrame,
    securities: DataFrame,
    extra: Sequence[str] = (),
    extra_dims: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Traded value per month, asset class and side, over a three-way star join.

    ``extra`` adds group columns that ``extra_dims`` (key -> dimension) bring in.
    """
    dims = {
        "trade_date": calendar.select(F.col("full_date").alias("trade_date"), "month_name", "year"),
        "security_id": securities,
        **(extra_dims or {}),
    }
    # summed per key first: a security with much of the fact reaches the join as a row a day
    own = [c for c in dict.fromkeys([*dims, *extra]) if c in fact.columns]
    sums = fact.groupBy(*own, "trade_type").agg(
        F.sum("trade_value").alias("_value"), F.count("*").alias("_rows")
    )
    groups = star_join(sums, dims).groupBy("month_name", "year", "asset_class", "trade_type", *extra)
    return groups.agg(
        total_of("_value").alias("total_traded_value"),
        F.sum("_rows").cast("bigint").alias("trade_count"),
    )


def review_summary(enriched: DataFrame, limit, by: Sequence[str] = ("desk",)) -> DataFrame:
    """Value and rows per group, split into trades over the limit and the rest."""
    flagged = with_flag_over(enriched, "trade_value", limit)
    return totals(flagged, [*by, "needs_review"], n="flagged_trade_count")


def flagged_share(
    enriched: DataFrame, limit, by: Sequence[str] = ("desk",), measure: str = "trade_value"
) -> DataFrame:
    """Flagged value as a percentage of the group's total, in one pass.

    Groups without a flagged row do not appear.
    """
    over = F.when(F.col(measure) > F.lit(limit), F.col(measure))
    sums = enriched.groupBy(*by).agg(
        total_of(over).alias("flagged_value"), total_of(measure).alias("group_total_value")
    )
    share = percent(F.col("flagged_value"), F.col("group_total_value"))
    return sums.where(F.col("flagged_value").isNotNull()).withColumn(
        "pct_of_group_total", share.cast("decimal(5,1)")
    )


def notional_by_date(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("trade_date").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("quantity") * F.col("price")).cast(TOTAL).alias("gross_notional"),
    )


def totals_by_each(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same totals by each column on its own, from one pass over the input."""
    sets = [[F.col(c)] for c in columns]
    one = df.groupingSets(sets, *columns).agg(
        total_of("trade_value").alias("total_trade_value"),
        F.count("*").alias("trade_count"),
        F.grouping_id().alias("_set"),
    )
    # grouping_id has a 0 bit for the column a row is grouped by
    full = 2 ** len(columns) - 1
    which = {c: full - 2 ** (len(columns) - 1 - i) for i, c in enumerate(columns)}
    kind = F.coalesce(*[F.when(F.col("_set") == s, F.lit(c)) for c, s in which.items()])
    value = F.coalesce(*[F.when(F.col("_set") == s, F.col(c)) for c, s in which.items()])
    return one.select(
        kind.alias("grouped_by"), value.alias("member"), "total_trade_value", "trade_count"
    )


def grand_total(df: DataFrame, measure: str = "total_trade_value") -> DataFrame:
    return df.agg(total_of(measure).alias(measure))


def month_total(df: DataFrame, year: int, month: int, measure="total_trade_value") -> DataFrame:
    """Total of one month of one year."""
    return grand_total(df.where(in_month("trade_date", year, month)), measure)
