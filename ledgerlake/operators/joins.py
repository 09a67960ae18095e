"""Star joins, key-set joins and point-in-time joins.

A side is broadcast only after its size was measured; past the limit the join is a
plain equi join that Spark shuffles, where adaptive execution splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import open_end

BROADCAST_LIMIT = 32 * 1024 * 1024


def _row_bytes(schema: T.StructType):
    fixed, varying = 0, F.lit(0)
    for f in schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            varying = varying + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            varying = varying + F.octet_length(F.to_json(F.struct(f.name)))
        fixed += 16
    return varying + fixed


def measured_bytes(*tables: DataFrame) -> list[int]:
    """Size of each table, from distributed aggregates in one job that returns a row each."""
    sizes = [
        df.agg(F.sum(_row_bytes(df.schema).cast("bigint")).alias("size")).withColumn(
            "table", F.lit(i)
        )
        for i, df in enumerate(tables)
    ]
    found = {r["table"]: r["size"] or 0 for r in reduce(DataFrame.union, sizes).collect()}
    return [found[i] for i in range(len(tables))]


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return limit > 0 and measured_bytes(df)[0] <= limit


def sized(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark for broadcast if it measures below the limit; ``limit=0`` leaves it to Spark."""
    return F.broadcast(df) if small(df, limit) else df


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], how: str = "inner") -> DataFrame:
    """Join each dimension on its key; Spark picks the strategy from its own statistics."""
    for key, dim in dims.items():
        fact = fact.join(dim, key, how)
    return fact


def enrich(
    fact: DataFrame, dims: Mapping[str, DataFrame], how: str = "left", limit: int = 0
) -> DataFrame:
    """Attach dimension attributes.

    Adaptive execution broadcasts a dimension that turns out small. With a ``limit`` the
    dimensions are measured first, together and at once, and those below it are broadcast:
    worth a job of its own where the fact must not be shuffled in any case.
    """
    if limit > 0:
        sizes = measured_bytes(*dims.values())
        dims = {
            key: F.broadcast(dim) if size <= limit else dim
            for (key, dim), size in zip(dims.items(), sizes, strict=True)
        }
    return star_join(fact, dims, how)


def key_set(keys: DataFrame, on: Sequence[str], limit: int = 0) -> DataFrame:
    """The distinct keys; repeats of a hot key merge map-side and never reach one task.

    Where the set is then shuffled for a join, the two share that shuffle.
    """
    return sized(keys.select(*on).distinct(), limit)


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], limit: int = 0) -> DataFrame:
    """Rows whose key is in the set. A ``limit`` measures the set and may broadcast it."""
    return df.join(key_set(keys, on, limit), list(on), "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], limit: int = 0) -> DataFrame:
    """Rows whose key is not in the set; a NULL key is kept."""
    return df.join(key_set(keys, on, limit), list(on), "left_anti")


def join_current(
    fact: DataFrame, history: DataFrame, key: str, how: str = "left", limit: int = 0
) -> DataFrame:
    """Join today's version only, so a versioned dimension cannot multiply the fact."""
    current = history.where("is_current").drop("valid_from", "valid_to", "is_current")
    return enrich(fact, {key: current}, how, limit)


def relate(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """A declared many-to-one relationship: refuses a dimension whose key repeats.

    One aggregate gives both the repeats and the size that decides on a broadcast.
    """
    rows = dim.groupBy(key).agg(
        F.count("*").alias("rows"), F.sum(_row_bytes(dim.schema).cast("bigint")).alias("bytes")
    )
    most, size = rows.agg(F.max("rows"), F.sum("bytes")).first()
    if (most or 0) > 1:
        raise ValueError(f"{key} is not unique on the one side of the relationship")
    return star_join(fact, {key: F.broadcast(dim) if 0 < limit and (size or 0) <= limit else dim}, how)


def join_as_of(
    fact: DataFrame,
    history: DataFrame,
    key: str,
    fact_date: str,
    how: str = "left",
    limit: int = BROADCAST_LIMIT,
    days: int = 92,
) -> DataFrame:
    """Attach the version valid on the fact's date; both ends of a version count, and a
    version without an end is still true.

    ``how`` is ``left`` or ``inner``: versions without a fact are not results here. The
    versions of a key must not overlap (``check_history`` tells).

    A history that measures small is broadcast. A larger one is merged with the fact, see
    ``_carried``; ``days`` is the length of the parts a key is split into.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"an as-of join is left or inner, not {how}")
    versions = history.drop("is_current").where(
        F.col(key).isNotNull() & F.col("valid_from").isNotNull()
    )
    shown = [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    shown += ["valid_from", "valid_to"]
    if not small(versions, limit):
        return _carried(fact, versions, key, fact_date, shown, how, days)
    right = F.broadcast(versions.withColumnRenamed(key, "_key"))
    inside = F.col(fact_date).cast("date").between(F.col("valid_from"), open_end())
    joined = fact.join(right, (F.col(key) == F.col("_key")) & inside, how)
    return joined.select(*fact.columns, *shown)


def _carried(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    fact_date: str,
    shown: Sequence[str],
    how: str,
    days: int,
) -> DataFrame:
    """The point-in-time join as a merge: one shuffle of facts and versions together.

    Rows are ordered by date within parts of (key, ``days`` days), and each fact takes the
    last version that began before it. A version is not repeated for the time it covers:
    for every part that holds a fact, one row brings in the version open when the part
    begins, found from the distinct (key, part) pairs. A key with a third of all rows thus
    lies on as many tasks as there are parts. Facts without key or date match nothing and
    stay with the rows they were read with.
    """
    part = F.floor(F.unix_date("_at") / days).cast("long")
    matched = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    facts = fact.select(
        F.col(key).alias("_key"),
        F.col(fact_date).cast("date").alias("_at"),
        F.lit(2).alias("_kind"),
        F.struct(*fact.columns).alias("_fact"),
    ).withColumn("_part", F.when(matched, part).otherwise(-1 - F.spark_partition_id()))
    starts = versions.select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*shown).alias("_version"),
    ).withColumn("_part", part)
    asked = (
        facts.where(matched)
        .select("_key", "_part")
        .distinct()
        .withColumns(
            {
                "_at": F.date_from_unix_date((F.col("_part") * days).cast("int")),
                "_kind": F.lit(0),  # before the versions that begin on the part's first day
            }
        )
    )
    last = F.last("_version", ignorenulls=True)
    by_key = W.partitionBy("_key").orderBy("_at", "_kind")
    opened = (
        asked.unionByName(starts, allowMissingColumns=True)
        .withColumn("_version", last.over(by_key.rowsBetween(W.unboundedPreceding, 0)))
        .where((F.col("_kind") == 0) & F.col("_version").isNotNull())
    )
    in_part = W.partitionBy("_key", "_part").orderBy("_at", "_kind")
    rows = (
        facts.unionByName(starts, allowMissingColumns=True)
        .unionByName(opened, allowMissingColumns=True)
        .withColumn("_version", last.over(in_part.rowsBetween(W.unboundedPreceding, 0)))
        .where("_kind = 2")
    )
    valid = matched & (F.col("_at") <= open_end("_version.valid_to"))
    if how == "inner":
        rows = rows.where(valid & F.col("_version").isNotNull())
    return rows.select(
        "_fact.*", *(F.when(valid, F.col(f"_version.`{c}`")).alias(c) for c in shown)
    )


def as_of(history: DataFrame, date) -> DataFrame:
    """The table as it was true on one date."""
    d = F.lit(date).cast("date")
    return history.where((F.col("valid_from") <= d) & (open_end() >= d))


def lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Add the value a mapping holds for a key, NULL where it holds none."""
    return enrich(df, {key: mapping.select(key, F.col(value).alias(name))}, "left")
