"""Keyed upserts, as one full outer join or as a rewrite of the touched partitions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.functions.columns import aligned
from ledgerlake.operators.joins import BROADCAST_LIMIT, keep_keys
from ledgerlake.session import with_settings
from ledgerlake.sinks.tables import write_keyed
from ledgerlake.sources.files import read_or_create

IN_LIST = 2000  # keys of a batch that are named to the scan one by one


def keyed_once(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source, refused where a key is missing or there twice, as MERGE refuses it.

    Either would be stored again by every run. The check runs with the rows; its window
    leaves them grouped and ordered by the keys, as the join that follows needs them.
    """
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    named = ", ".join(keys)
    times = F.count("*").over(W.partitionBy(*keys))
    good = (
        F.when(missing, F.raise_error(f"a source row has no {named}").cast("boolean"))
        .when(times > 1, F.raise_error(f"{named} repeats in the source").cast("boolean"))
        .otherwise(True)
    )
    return source.withColumn("_once", good).where("_once").drop("_once")


def _pairs(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    rows = keyed_once(aligned(source, target), keys)
    return target.select(*keys, F.struct("*").alias("old")).join(
        rows.select(*keys, F.struct("*").alias("new")), list(keys), how
    )


def _merged(name: str, update_cols: Sequence[str]) -> Column:
    old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
    if name in update_cols:
        return F.when(F.col("new").isNotNull(), new).otherwise(old)
    return F.when(F.col("old").isNotNull(), old).otherwise(new)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """Matched keys take ``update_cols`` from the source and keep the rest; unmatched
    source rows are inserted; target rows without a source row stay.

    A source that holds a key twice, or a row without one, fails the run. Columns the
    source lacks are inserted as NULL.
    """
    pairs = _pairs(target, source, keys, "full_outer")
    return pairs.select([_merged(c, update_cols).alias(c) for c in target.columns])


def upsert_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """What an upsert does: replaced rows with ``sign`` -1 and their successors with +1.

    Inserted rows have a successor only. Summed with the sign, a measure tells by how much
    any aggregate of the target changes.
    """
    pairs = _pairs(target, source, keys, "right")
    names = target.columns
    old = F.struct(*(F.col(f"old.{c}").alias(c) for c in names), F.lit(-1).alias("sign"))
    new = F.struct(*(_merged(c, update_cols).alias(c) for c in names), F.lit(1).alias("sign"))
    rows = F.array(F.when(F.col("old").isNotNull(), old), new)
    return pairs.select(F.inline(F.array_compact(rows)))


def matching_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source holds, by a filter that reaches the row groups.

    Up to IN_LIST keys are named to the scan; Parquet then skips row groups by their
    statistics, dictionaries and Bloom filters. For more keys their lowest and highest
    are named, and a semi join does the rest.
    """
    found = source.select(key).distinct().limit(IN_LIST + 1).collect()
    values = [r[0] for r in found if r[0] is not None]
    if len(found) <= IN_LIST:
        return target.where(F.col(key).isin(values))
    low, high = source.agg(F.min(key), F.max(key)).first()
    return keep_keys(target.where(F.col(key).between(low, high)), source, [key], BROADCAST_LIMIT)


def touched_partitions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str
) -> list:
    """Values of the partition column that an upsert changes: at most one per folder."""
    with with_settings(
        target.sparkSession, {"spark.sql.parquet.pushdown.inFilterThreshold": str(IN_LIST)}
    ):
        if len(keys) == 1:
            matched = matching_rows(target, source, keys[0])
        else:
            matched = keep_keys(target.select(*keys, partition), source, keys, BROADCAST_LIMIT)
        touched = matched.select(partition).union(source.select(partition)).distinct()
        return [row[0] for row in touched.collect()]


def in_partitions(target: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of some folders, the one of rows without a value included."""
    named = F.col(partition).isin([v for v in values if v is not None])
    return target.where(named | (F.col(partition).isNull() if None in values else F.lit(False)))


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    partition: str,
    touched: list | None = None,
) -> list:
    """Upsert into the Parquet table at ``path``, partitioned by one column.

    Only partitions that hold a matched key or receive a new row are rewritten, and
    returned. They are found from the key and partition columns alone, in the row groups
    that can hold a key of the batch: partitions are written in the order of the first key
    and with Bloom filters on it. Rows without a partition value have a folder too. A
    matched row stays in its folder, so the partition column cannot be updated. A key that
    is missing or there twice in the source fails the run before anything is replaced.
    ``touched`` saves looking where ``touched_partitions`` was asked already; the source is
    then read once and not kept.
    """
    if partition in update_cols:
        raise ValueError(f"{partition} decides the folder of a row and cannot be updated")
    target = read_or_create(spark, path, source.schema, partition)
    values = touched
    if values is None:
        source = source.persist()
    try:
        if values is None:
            values = touched_partitions(target, source, keys, partition)
        if values:
            part = in_partitions(target, partition, values)
            write_keyed(upsert(part, source, keys, update_cols), path, partition, keys[0])
    finally:
        source.unpersist()
    return values
