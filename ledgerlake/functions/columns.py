"""Column builders and small projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END_OF_TIME = "9999-12-31"  # fixed value: valid_to of a row that is still true


def trade_value(quantity="quantity", price="price", money: T.DataType = T.DecimalType(18, 2)):
    """quantity x price to the cent; exact when both inputs are decimals."""
    return F.round(F.col(quantity) * F.col(price), 2).cast(money)


def with_trade_value(df: DataFrame, name: str = "trade_value") -> DataFrame:
    return df.withColumn(name, trade_value())


def with_flag_over(df: DataFrame, measure: str, limit, name: str = "needs_review") -> DataFrame:
    return df.withColumn(name, F.col(measure) > F.lit(limit))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """part as a percentage of whole; NULL where whole is zero."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def average(total: Column, n: Column, digits: int = 2) -> Column:
    """Rounded mean from an exact decimal total and a count, so it can be re-aggregated."""
    return F.round(F.try_divide(total.cast("decimal(28,4)"), n.cast("decimal(20,0)")), digits)


def staged(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Project to the declared names and types; ``strict=False`` turns bad text into NULL."""
    present = set(df.columns)
    return df.select(
        [
            (
                F.lit(None).cast(f.dataType)
                if f.name not in present
                else F.col(f.name).cast(f.dataType)
                if strict
                else F.col(f.name).try_cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def aligned(df: DataFrame, like: DataFrame | T.StructType) -> DataFrame:
    """Same columns, order and types as ``like``; columns df lacks become typed NULLs."""
    return staged(df, like.schema if isinstance(like, DataFrame) else like)


def with_constants(df: DataFrame, values: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add literal columns given as ``name -> (value, type)``; the value may be None."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in values.items()})


def with_audit(df: DataFrame, at=None, name: str = "silver_loaded_ts") -> DataFrame:
    """Load time; pass it in to make reruns reproducible."""
    stamp = F.lit(at).cast("timestamp_ntz") if at is not None else F.localtimestamp()
    return df.withColumn(name, stamp)


def day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def day_before(value) -> Column:
    return F.date_sub(day(value), 1)


def open_end(column: str | Column = "valid_to") -> Column:
    """The last day of a version; one without an end is still true."""
    end = F.col(column) if isinstance(column, str) else column
    return F.coalesce(end, F.lit(END_OF_TIME).cast("date"))


def previous_window(run_ts) -> Column:
    """The window a scheduled run works on: the day before it, as yyyy-MM-dd text."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    return F.date_format(F.date_sub(ts.cast("date"), 1), "yyyy-MM-dd")


def in_month(column: str, year: int, month: int) -> Column:
    """A closed-open date range rather than month(): it reaches the scan as a filter."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    return (F.col(column) >= first) & (F.col(column) < F.add_months(first, 1))


def first_present(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns])


def differs(columns: Iterable[str], left: str, right: str, null_safe: bool = True) -> Column:
    """True when any compared column differs between two aliased sides.

    Null-safe by default; ``null_safe=False`` misses changes from or to NULL.
    """
    out = F.lit(False)
    for c in columns:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        out = out | (~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False)))
    return out
