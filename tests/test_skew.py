"""One key holds a third of all rows: results stay whole, and the key is cut up before it meets."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold, history, joins, security
from ledgerlake.streaming import arrivals

ROWS = 30000


@pytest.fixture(scope="module")
def fact(spark):
    """Key 7 on every third row, values and dates spread evenly."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    return spark.range(0, ROWS, 1, 8).select(
        "id",
        hot.cast("long").alias("trader_id"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("d"),
        F.lit(1).cast("decimal(18,2)").alias("trade_value"),
        F.lit(2).cast("decimal(18,4)").alias("price"),
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_through_a_large_dimension(spark, fact):
    dim = spark.range(1000).select(
        F.col("id").alias("trader_id"), (F.col("id") % 4).alias("desk")
    )
    out = gold.totals_through(fact, dim, "trader_id", ["desk"], limit=0)
    found = {r.desk: (int(r.total_trade_value), r.trade_count) for r in out.collect()}
    wanted = {}
    for i in range(ROWS):
        desk = (7 if i % 3 == 0 else i % 1000) % 4
        wanted[desk] = wanted.get(desk, 0) + 1
    assert found == {k: (n, n) for k, n in wanted.items()}
    # the fact is summed per key below the join
    text = plan(out)
    assert text.index("Join") < text.index("HashAggregate(keys=[trader_id")


def test_key_sets_drop_repeats_before_the_join(fact):
    hot = fact.select("trader_id")
    kept = joins.keep_keys(fact, hot, ["trader_id"])
    assert kept.count() == ROWS
    assert joins.drop_keys(fact, hot, ["trader_id"]).isEmpty()
    assert "HashAggregate(keys=[trader_id" in plan(kept)


def test_point_in_time_join_spreads_a_hot_key_over_parts(spark, fact):
    """The hot key also changes every day, so its versions are many as well."""
    days = spark.range(300).select(
        F.lit(7).cast("long").alias("trader_id"),
        F.col("id").alias("version"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
    )
    table = history.scd2_from_snapshots(days, "trader_id", ["version"], "day")
    out = joins.join_as_of(fact, table, "trader_id", "d", limit=0)
    assert out.count() == ROWS
    wrong = F.when(
        F.col("trader_id") == 7, ~F.col("version").eqNullSafe(F.col("id") % 300)
    ).otherwise(F.col("version").isNotNull())
    assert out.where(wrong).isEmpty()
    spread = joins.join_as_of(fact, table, "trader_id", "d", limit=0, days=10)
    tasks = spread.where("trader_id = 7").select(F.spark_partition_id()).distinct().count()
    assert tasks > 2  # of 8; the parts of the hot key hash to several of them
    assert "explode" not in plan(spread).lower()  # no version is repeated per part
    report = history.check_history(table, "trader_id").first()
    assert (report.versions, report.consistent) == (300, True)


def test_visibility_of_a_hot_key(spark, fact):
    logins = fact.select("trader_id").distinct().withColumn(
        "login_name", F.concat(F.lit("u"), F.col("trader_id"))
    )
    report = security.visibility_report(fact, logins, "trader_id", "trade_value", "all")
    seen = {r.login_name: r.visible_rows for r in report.collect()}
    assert seen.pop("all") == sum(seen.values()) == ROWS
    assert seen["u7"] > ROWS // 3


def test_arriving_copies_of_one_row(spark, tmp_path):
    copies = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id")
    )
    for _ in range(2):
        arrivals.append_new(spark, copies, str(tmp_path / "out"), "2026-05-01")
    assert arrivals.read_ingested(spark, str(tmp_path / "out")).count() == ROWS * 2 // 3 + 1
