"""Declarative data checks. A check yields its failing rows; none means it passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from ledgerlake.operators.joins import BROADCAST_LIMIT, drop_keys
from ledgerlake.operators.reconcile import duplicate_keys


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return duplicate_keys(df.dropna(subset=list(columns)), columns)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their number of rows; NULL is not a value."""
    outside = df.where(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent lacks; a child without a key is no failure."""
    keys = parent.select(F.col(key).alias(column))
    return drop_keys(child.where(F.col(column).isNotNull()), keys, [column], BROADCAST_LIMIT)


def positive_value(df: DataFrame, column: str) -> DataFrame:
    """Rows at or below zero; NULL is neither."""
    return df.where(F.col(column) <= 0)


def expression_check(df: DataFrame, fails: Column | str) -> DataFrame:
    """Rows for which the condition of failure holds."""
    return df.where(fails)


@dataclass(frozen=True)
class Check:
    """One check of a table.

    ``fails`` marks failing rows, so all such checks of a table share one scan;
    ``rows`` builds the failing rows where that takes a join or a group, and ``count``
    counts them where one aggregate of the table can do so nevertheless.
    """

    name: str
    table: str
    fails: Column | None = None
    rows: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    severity: str = "error"
    count: Column | None = None

    @property
    def counted(self) -> Column | None:
        return F.count_if(self.fails) if self.fails is not None else self.count

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return self.rows(tables) if self.rows else tables[self.table].where(self.fails)


def check_unique(table: str, column: str, severity: str = "error") -> Check:
    return Check(
        f"unique_{table}_{column}", table, None, lambda t: unique(t[table], column), severity
    )


def check_not_null(table: str, column: str, severity: str = "error") -> Check:
    return Check(f"not_null_{table}_{column}", table, F.col(column).isNull(), None, severity)


def check_accepted(table: str, column: str, values: Sequence, severity: str = "error") -> Check:
    """Counts distinct bad values, the way the report lists them."""
    return Check(
        f"accepted_values_{table}_{column}",
        table,
        None,
        lambda t: accepted_values(t[table], column, values),
        severity,
        F.count_distinct(F.when(~F.col(column).isin(list(values)), F.col(column))),
    )


def check_relationship(
    table: str, column: str, parent: str, key: str, severity: str = "error"
) -> Check:
    return Check(
        f"relationships_{table}_{column}",
        table,
        None,
        lambda t: relationships(t[table], column, t[parent], key),
        severity,
    )


def check_positive(table: str, column: str, severity: str = "error") -> Check:
    return Check(f"positive_value_{table}_{column}", table, F.col(column) <= 0, None, severity)


def check_expression(name: str, table: str, fails: Column, severity: str = "error") -> Check:
    return Check(name, table, fails, None, severity)


def run_checks(tables: Mapping[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """One row per check: name, table, severity, failing rows, passed.

    Checks of one table that need no join or group are counted together in one aggregate.
    """
    results = []
    for table in dict.fromkeys(c.table for c in suite if c.counted is not None):
        group = [c for c in suite if c.table == table and c.counted is not None]
        counts = tables[table].agg(*[c.counted.alias(f"_{i}") for i, c in enumerate(group)])
        lines = [_line(c, F.col(f"_{i}")) for i, c in enumerate(group)]
        results.append(counts.select(F.inline(F.array(*lines))))
    for c in suite:
        if c.counted is None:
            counted = c.failing(tables).agg(F.count("*").alias("_n"))
            results.append(counted.select(F.inline(F.array(_line(c, F.col("_n"))))))
    rows = reduce(DataFrame.unionByName, results)
    return rows.withColumn("passed", F.col("failing_rows") == 0)


def _line(check: Check, failing: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.severity).alias("severity"),
        failing.alias("failing_rows"),
    )


def watched(df: DataFrame, suite: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """The rows, counted by the row checks of a suite while something writes them."""
    seen = Observation()
    counts = [F.count_if(c.fails).alias(f"_{i}") for i, c in enumerate(suite) if c.fails is not None]
    return df.observe(seen, F.count("*").alias("rows"), *counts), seen


def watched_results(
    seen: Observation, suite: Sequence[Check], tables: Mapping[str, DataFrame]
) -> list[Row]:
    """Results of a suite of one table after it was written: no scan for row checks.

    Only checks that take a group or a join read the stored table, the columns they need.
    """
    counts = seen.get
    results = [
        (c.name, c.table, c.severity, counts[f"_{i}"], counts[f"_{i}"] == 0)
        for i, c in enumerate(suite)
        if c.fails is not None
    ]
    rest = [c for c in suite if c.fails is None]
    names = Row("check_name", "table_name", "severity", "failing_rows", "passed")
    scanned = run_checks(tables, rest).collect() if rest else []
    return [*(names(*r) for r in results), *scanned]


def refuse_failed(results: Sequence[Row]) -> None:
    """Raise if a check of severity ``error`` failed."""
    failed = [r for r in results if not r.passed and r.severity == "error"]
    if failed:
        raise ChecksFailed(failed)


class ChecksFailed(Exception):
    """Raised by the gate; holds the failed results."""

    def __init__(self, failed):
        super().__init__("; ".join(f"{r.check_name}: {r.failing_rows} failing" for r in failed))
        self.failed = failed


def gate(
    tables: Mapping[str, DataFrame],
    suite: Sequence[Check],
    publish: Callable[[], None] | None = None,
):
    """Run the suite, and publish only if no check of severity ``error`` failed.

    Returns the results (one row per check); failed warnings are reported there.
    """
    results = run_checks(tables, suite).collect()
    refuse_failed(results)
    if publish:
        publish()
    return results


def blotter_suite() -> list[Check]:
    """The checks of the blotter lakehouse: seed, Bronze, Silver and Gold."""
    return [
        check_unique("dim_trader", "trader_id"),
        check_not_null("dim_trader", "trader_id"),
        check_unique("silver_trades", "trade_id"),
        check_not_null("silver_trades", "trade_id"),
        check_accepted("silver_trades", "trade_type", ["BUY", "SELL"]),
        check_positive("silver_trades", "quantity"),
        check_positive("silver_trades", "price"),
        check_relationship("gold_fact_trades_daily", "trader_id", "gold_dim_trader", "trader_id"),
        check_unique("gold_dim_trader", "trader_id"),
        check_not_null("gold_dim_trader", "trader_id"),
        # fails on a dirty feed on purpose: Bronze is where bad input should show
        check_expression(
            "bronze_trades_positive_quantity_and_price",
            "bronze_trades",
            (F.col("quantity") <= 0) | (F.col("price") <= 0),
            severity="warn",
        ),
    ]
