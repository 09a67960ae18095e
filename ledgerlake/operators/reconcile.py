"""Row counts and totals that must agree between layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.gold import TOTAL


def reconcile(bronze: DataFrame, silver: DataFrame, window: str = "trade_date") -> DataFrame:
    """Bronze rows, Silver rows and rows removed, for every window in either layer."""
    sides = [
        df.groupBy(window).agg(F.count("*").alias("n")).withColumn("side", F.lit(side))
        for df, side in ((bronze, "bronze"), (silver, "silver"))
    ]

    def count_of(side: str):
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))

    counts = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(window)
        .agg(
            count_of("bronze").alias("bronze_row_count"),
            count_of("silver").alias("silver_row_count"),
        )
    )
    return counts.withColumn(
        "removed_row_count", F.col("bronze_row_count") - F.col("silver_row_count")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_records")).where("n_records > 1")


def audit_parts(
    df: DataFrame, key: str, measure: str, mapping: DataFrame | None = None
) -> DataFrame:
    """One row: do the parts that viewers see add up to the whole?

    With a login map a row counts once per login that sees it, so rows nobody sees and
    rows two logins see both break the sum. Without one, rows lacking a key break it.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"), F.sum(measure).alias("v"))
    if mapping is None:
        seen = per_key.withColumn("viewers", F.when(F.col(key).isNotNull(), 1).otherwise(0))
    else:
        viewers = mapping.groupBy(key).agg(F.count_distinct("login_name").alias("viewers"))
        seen = per_key.join(viewers, key, "left").na.fill(0, ["viewers"])
    sums = seen.agg(
        F.count(F.when(F.col("viewers") > 0, True)).alias("parts"),
        F.sum(F.col("n") * F.col("viewers")).cast("bigint").alias("rows_in_parts"),
        F.sum("n").alias("rows_in_whole"),
        F.sum(F.col("v") * F.col("viewers")).cast(TOTAL).alias("value_in_parts"),
        F.sum("v").cast(TOTAL).alias("value_in_whole"),
    )
    agrees = (F.col("rows_in_parts") == F.col("rows_in_whole")) & (
        F.col("value_in_parts") == F.col("value_in_whole")
    )
    return sums.withColumn("agrees", F.coalesce(agrees, F.lit(False)))


def reconcile_totals(
    upper: DataFrame, lower: DataFrame, upper_measure: str, lower_measure: str, tolerance=0
) -> DataFrame:
    """One row: both totals, their difference, and whether it is within the tolerance."""
    a = upper.agg(F.sum(upper_measure).cast(TOTAL).alias("upper_total"))
    b = lower.agg(F.sum(lower_measure).cast(TOTAL).alias("lower_total"))
    both = a.withColumn("lower_total", F.lit(None).cast(TOTAL)).unionByName(
        b.withColumn("upper_total", F.lit(None).cast(TOTAL))
    )
    one = both.agg(
        F.max("upper_total").alias("upper_total"), F.max("lower_total").alias("lower_total")
    )
    gap = F.abs(F.col("upper_total") - F.col("lower_total"))
    return one.withColumn("difference", gap).withColumn(
        "agrees", F.coalesce(F.col("difference") <= F.lit(tolerance), F.lit(False))
    )


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, NULLs, the sum where it is numeric, and the values left out of it.

    Values are summed as decimals, so the sum is the same in whatever order the rows come:
    decimals at their own scale, other numbers to ten digits, and only the sum is rounded to
    four. NaN, infinity and numbers of 1e18 or more have no place in it; ``unsummed_count``
    tells how many there are.
    """
    kinds = dict(df.dtypes)
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double")

    def exact(c: str):
        kind = kinds[c]
        if kind.startswith("decimal"):
            return F.col(c)
        if kind in plain:
            return F.col(c).try_cast("decimal(28,10)" if kind in plain[-2:] else "decimal(28,0)")
        return None

    values = {c: exact(c) for c in df.columns}

    def total(v):
        return (F.lit(None) if v is None else F.sum(v)).cast("decimal(38,4)")

    def unsummed(c: str, v):
        return F.lit(0) if v is None else F.count(c) - F.count(v)

    stats = df.agg(
        F.count("*").alias("_n"),
        *[F.count(c).alias(f"_present_{i}") for i, c in enumerate(df.columns)],
        *[total(v).alias(f"_sum_{i}") for i, v in enumerate(values.values())],
        *[unsummed(c, v).alias(f"_odd_{i}") for i, (c, v) in enumerate(values.items())],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds[c]).alias("column_type"),
            F.col("_n").alias("row_count"),
            (F.col("_n") - F.col(f"_present_{i}")).alias("null_count"),
            F.col(f"_sum_{i}").alias("column_sum"),
            F.col(f"_odd_{i}").cast("bigint").alias("unsummed_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return stats.select(F.inline(F.array(*rows)))
