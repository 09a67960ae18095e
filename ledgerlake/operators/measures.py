"""Governed measures: named aggregates, sliced by any column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.gold import TOTAL
from ledgerlake.operators.joins import join_current


def measures() -> dict[str, Column]:
    """The one definition of each measure over the daily Gold fact."""
    return {
        "Total Trade Value": F.sum("total_trade_value").cast(TOTAL),
        "Trade Count": F.sum("trade_count").cast("bigint"),
    }


def measure(
    fact: DataFrame, names: str | Sequence[str], by: Sequence[str] = (), where=None
) -> DataFrame:
    """Evaluate measures, optionally sliced and filtered."""
    wanted = [names] if isinstance(names, str) else list(names)
    rows = fact if where is None else fact.where(where)
    return rows.groupBy(*by).agg(*[measures()[n].alias(n) for n in wanted])


def measure_current(
    fact: DataFrame,
    history: DataFrame,
    key: str,
    names: str | Sequence[str],
    by: Sequence[str] = (),
    where=None,
) -> DataFrame:
    """Measures sliced by today's version of a versioned dimension."""
    return measure(join_current(fact, history, key), names, by, where)


def assert_total(result: DataFrame, name: str, expected) -> None:
    """Raise unless a one-row measure equals a known control total."""
    found = result.first()[name]
    if found != expected:
        raise AssertionError(f"{name} is {found}, expected {expected}")
