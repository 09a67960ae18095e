"""Row-level security: rows a caller may see, through a login map."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.gold import total_of, totals
from ledgerlake.operators.joins import BROADCAST_LIMIT, keep_keys
from ledgerlake.sinks.tables import quoted


def caller(df: DataFrame, principal: str | None) -> str:
    """The login a request counts for: the one given, else the session's own user."""
    if principal is not None:
        return principal
    return df.sparkSession.range(1).select(F.session_user()).first()[0]


def visible_keys(mapping: DataFrame, principal: str | Column | None, key: str) -> DataFrame:
    """Keys mapped to a login; the session's own user when none is given."""
    who = principal if isinstance(principal, Column) else F.lit(principal)
    if principal is None:
        who = F.session_user()
    return mapping.where(F.col("login_name") == who).select(key)


def row_filter(
    df: DataFrame,
    mapping: DataFrame,
    principal: str | None,
    admins: Collection[str] = (),
    key: str = "trader_id",
) -> DataFrame:
    """Rows of the caller's own keys; an admin sees all, an unknown login nothing."""
    principal = caller(df, principal)
    if principal in admins:
        return df
    return keep_keys(df, visible_keys(mapping, principal, key), [key], BROADCAST_LIMIT)


def row_filter_via_dim(
    fact: DataFrame,
    dim: DataFrame,
    mapping: DataFrame,
    principal: str | None,
    admins: Collection[str] = (),
    key: str = "trader_id",
) -> DataFrame:
    """Restrict the dimension; the relationship carries the restriction to the fact."""
    principal = caller(fact, principal)
    if principal in admins:
        return fact
    seen = row_filter(dim, mapping, principal, (), key).select(key)
    return keep_keys(fact, seen, [key], BROADCAST_LIMIT)


def group_filter(
    df: DataFrame, dim: DataFrame, rule: Column | str, key: str = "trader_id"
) -> DataFrame:
    """Rows whose dimension row satisfies a rule, such as one desk's."""
    return keep_keys(df, dim.where(rule), [key], BROADCAST_LIMIT)


def own_rows(key_value: int | None, key: str = "trader_id") -> Column:
    """Predicate for one identity; None is unrestricted. The value is bound, not spliced."""
    return F.lit(True) if key_value is None else F.col(key) == F.lit(key_value)


def live_totals(silver: DataFrame, predicate: Column) -> DataFrame:
    """Totals by side, restricted each time the result is read."""
    return totals(silver.where(predicate), ["trade_type"])


def frozen_extract(
    silver: DataFrame, predicate: Column, path: str, spark: SparkSession
) -> DataFrame:
    """The totals one fixed identity sees, stored once; every reader then gets the same."""
    live_totals(silver, predicate).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def visibility_report(
    df: DataFrame, mapping: DataFrame, key: str, measure: str, everyone: str | None = None
) -> DataFrame:
    """Rows and value each login sees, for all logins at once.

    The fact is summed per key before it meets the map. ``everyone`` names an extra
    line for an unrestricted viewer.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("_rows"), F.sum(measure).alias("_value"))
    mapped = per_key.join(mapping.select(key, "login_name").distinct(), key)
    report = _visible(mapped, [F.col("login_name")])
    if everyone is None:
        return report
    return report.unionByName(_visible(per_key, [F.lit(everyone).alias("login_name")]))


def _visible(per_key: DataFrame, who: Sequence[Column]) -> DataFrame:
    return per_key.groupBy(*who).agg(
        F.sum("_rows").alias("visible_rows"), total_of("_value").alias("visible_value")
    )


def as_text(value: str) -> str:
    """A value as a SQL string, whatever signs it holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_visibility_function(
    spark: SparkSession, name: str, mapping_table: str, admins: Collection[str] = ()
) -> None:
    """A SQL table function: one row when a login may see a key, none otherwise.

    Admins see every key. Use it as ``FROM fact, LATERAL name(fact.trader_id, login)``.
    """

    listed = ", ".join(["NULL", *map(as_text, admins)])
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(key BIGINT, login STRING)
        RETURNS TABLE (is_visible INT)
        RETURN SELECT DISTINCT 1 FROM {mapping_table} m
               WHERE (m.trader_id = key AND m.login_name = login) OR login IN ({listed})
        """
    )


def create_secured_view(
    spark: SparkSession, name: str, table: str, mapping_table: str, admin: str, key="trader_id"
) -> None:
    """A view that shows each reader their own rows, evaluated anew in every query.

    Bind it once per protected table (fact and dimension) with the same map. The names are
    values in the plan, never parts of a text.
    """
    me = F.session_user()
    mine = spark.table(mapping_table).where(F.col("login_name") == me)
    mine = mine.select(F.col(key).alias("_mine")).distinct()
    rows = spark.table(table)
    seen = rows.join(mine, F.col(key) == F.col("_mine"), "left")
    seen = seen.where(F.col("_mine").isNotNull() | (me == F.lit(admin)))
    seen.select(*rows.columns).createOrReplaceTempView(name)


def create_stored_secured_view(
    spark: SparkSession,
    name: str,
    table: str,
    mapping_table: str,
    admins: Collection[str] = (),
    key: str = "trader_id",
) -> None:
    """The same policy as a view of the catalog, so it outlives the session that made it.

    Whoever reads the view, in whatever session, gets the rows of their own keys: the
    reader's name is asked for when the view is read. Table and map must be tables or
    views of the catalog themselves.
    """
    column = quoted(key)
    listed = ", ".join(["NULL", *map(as_text, admins)])
    spark.sql(
        f"""
        CREATE OR REPLACE VIEW {quoted(name)} AS
        SELECT f.* FROM {quoted(table)} AS f
        WHERE session_user() IN ({listed})
           OR EXISTS (SELECT 1 FROM {quoted(mapping_table)} AS m
                      WHERE m.{column} = f.{column} AND m.login_name = session_user())
        """
    )
