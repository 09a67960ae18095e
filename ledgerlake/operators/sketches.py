"""Profiles that add up: counts and sketches per part, stored and merged; exact figures."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12  # relative standard error of a distinct count: 1.04 / sqrt(2 ** 12), 1.6 %
KLL_SIZE = 200  # a quantile's rank is off by about 1.3 % or less, with 99 % confidence
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def part_profile(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per part and column: rows, NULLs, smallest and largest value, and two sketches.

    One aggregate over the parts given; each keeps a few kilobytes a column, however many
    rows it has. Numbers have a sketch of their quantiles too. NaN has no place in one.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    stats = [F.count("*").alias("_rows")]
    lines = []
    for i, c in enumerate(columns):
        number = F.col(c).cast("double") if isinstance(kinds[c], T.NumericType) else None
        stats += [
            F.count(c).alias(f"_present{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), HLL_BITS).alias(f"_distinct{i}"),
        ]
        spread = F.lit(None).cast("binary")
        if number is not None:
            fit = F.when(~F.isnan(number), number)
            stats.append(F.kll_sketch_agg_double(fit, F.lit(KLL_SIZE)).alias(f"_spread{i}"))
            spread = F.col(f"_spread{i}")
        lines.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_present{i}")).alias("null_count"),
                F.col(f"_distinct{i}").alias("distinct_sketch"),
                spread.alias("spread_sketch"),
            )
        )
    return df.groupBy(*by).agg(*stats).select(*by, F.inline(F.array(*lines)))


def merged_profile(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile of all parts, or of groups of them, from their stored sketches alone."""
    merged = parts.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("spread_sketch").alias("spread_sketch"),
    )
    some = F.kll_sketch_get_n_double("spread_sketch") > 0
    quantiles = F.when(
        some,
        F.kll_sketch_get_quantile_double(
            "spread_sketch", F.array(*(F.lit(float(q)) for q in QUANTILES))
        ),
    )
    return merged.select(
        *by,
        "column_name",
        "row_count",
        "null_count",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        quantiles.alias("quantiles"),
    )


def ranged_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n, part: how often a column's values are there, in parts of ascending ranges.

    Counts merge before the shuffle and a part is as large as a shuffle partition, so no
    task holds all values. To be stored: the parts' numbers hold for one run.
    """
    present = df.where(F.col(column).isNotNull())
    counts = present.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.repartitionByRange("value").withColumn("part", F.spark_partition_id())


def counted_figures(counts: DataFrame, shares: Sequence[float] = ()) -> tuple[int, list]:
    """Number of distinct values and exact quantiles, from stored ``ranged_counts``.

    The quantiles lie between neighbours as ``percentile`` has them. The driver gets a row
    per part and a value per neighbour; only parts that hold one are ranked.
    """
    parts = counts.groupBy("part").agg(
        F.min("value").alias("low"), F.count("*").alias("values"), F.sum("n").alias("n")
    )
    before, offsets = 0, {}
    for row in parts.orderBy("low").collect():
        offsets[row["part"]] = (before, before + row["n"])
        before += row["n"]
    distinct = parts.agg(F.sum("values")).first()[0] or 0
    if not before or not shares:
        return distinct, [None] * len(shares)
    places = [share * (before - 1) for share in shares]
    ranks = sorted({k for place in places for k in (math.floor(place), math.ceil(place))})
    held = {p: o for p, o in offsets.items() if any(o[0] <= k < o[1] for k in ranks)}
    up_to = F.sum("n").over(W.partitionBy("part").orderBy("value"))
    first = F.coalesce(*(F.when(F.col("part") == p, F.lit(o[0])) for p, o in held.items()))
    ranked = counts.where(F.col("part").isin(list(held))).withColumn("up_to", first + up_to)
    at = ranked.agg(*(F.min(F.when(F.col("up_to") > k, F.col("value"))) for k in ranks)).first()
    value = dict(zip(ranks, map(float, at), strict=True))
    return distinct, [
        value[math.floor(p)] + (p - math.floor(p)) * (value[math.ceil(p)] - value[math.floor(p)])
        for p in places
    ]
