from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixtures import SEED, trades
from ledgerlake.functions import columns
from ledgerlake.operators import conform, joins, reconcile
from ledgerlake.schemas import TRADES


def test_seed_gives_nine_silver_rows(spark):
    silver = conform.silver_trades(trades(spark))
    assert silver.count() == 9
    kept = {r.trade_id: r.trade_value for r in silver.collect()}
    assert 100010 not in kept and 100006 in kept
    assert kept[100001] == D("7751250.00")


def test_rejected_rows_name_the_first_broken_rule(spark, rows):
    bronze = trades(spark, [*SEED, (7, "2026-05-06", 1, 1, "BUY", "5", "0", "2026-05-06 10:00:00")])
    rejected = conform.rejected_trades(bronze)
    assert rows(rejected, "trade_id", "reason") == [(7, "price"), (100010, "quantity")]


def test_newest_bad_version_hides_older_good_one(spark):
    bronze = trades(
        spark,
        [
            (1, "2026-05-01", 1, 1, "BUY", "10", "2", "2026-05-01 10:00:00"),
            (1, "2026-05-01", 1, 1, "BUY", "-10", "2", "2026-05-01 11:00:00"),
        ],
    )
    assert conform.silver_trades(bronze).isEmpty()


def test_good_and_rejected_are_the_input_even_with_nulls(spark):
    bronze = trades(
        spark,
        [
            (1, "2026-05-01", 1, 1, "BUY", None, "2", "2026-05-01 10:00:00"),
            (2, "2026-05-01", 1, 1, "BUY", "1", None, "2026-05-01 10:00:00"),
            (3, "2026-05-01", 1, 1, "BUY", "1", "1", "2026-05-01 10:00:00"),
        ],
    )
    good, rejected = conform.split_valid(bronze, conform.trade_rules())
    assert [r.trade_id for r in good.collect()] == [3]
    assert {r.trade_id: r.reason for r in rejected.collect()} == {1: "quantity", 2: "price"}


def test_equal_times_are_decided_by_the_tie_columns(spark):
    at = "2026-05-01 10:00:00"
    raw = [(1, "2026-05-01", 1, 1, "BUY", str(q), "2", at) for q in (5, 9, 7)]
    for order in (raw, raw[::-1]):
        kept = conform.newest_trades(trades(spark, order).repartition(3)).collect()
        assert [r.quantity for r in kept] == [D(9)]


def test_dedupe_is_idempotent(spark, rows):
    once = conform.newest_trades(trades(spark, SEED + SEED[:4]))
    assert rows(conform.newest_trades(once)) == rows(once)


def test_dedupe_limits_rows_before_the_shuffle(spark):
    plan = conform.newest_trades(trades(spark))._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning(trade_id", 1 + 0)
    assert "WindowGroupLimit" in after and "WindowGroupLimit" in before


def test_dedupe_of_a_hot_key(spark):
    """One key holds a third of all rows; the answer is exact and one row per key."""
    base = spark.range(30000)
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = base.select(key.alias("k"), F.col("id").alias("v"))
    kept = conform.latest_per_key(df, ["k"], ["v"], ["v"])
    assert kept.count() == 20001
    assert kept.where("k = -1").first().v == 29997


def test_exact_copies_collapse(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, name string")
    assert conform.distinct_rows(df).count() == 2


def test_staging_casts_and_fills(spark):
    df = spark.createDataFrame(
        [("1", "2026-05-01", "x", "7.5")], "trade_id string, trade_date string, security_id string, price string"
    )
    row = columns.staged(df, TRADES, strict=False).first()
    assert row.security_id is None and row.price == D("7.5000") and row.last_modified_ts is None


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(None, 4, D("1.00"), D("3.00"))], "a int, b int, x decimal(18,2), y decimal(18,2)")
    row = df.select(
        columns.first_present("a", "b").alias("key"),
        columns.percent(F.col("x"), F.col("y")).alias("pct"),
        columns.percent(F.col("x"), F.col("y") - 3).alias("undefined"),
        columns.previous_window("2026-05-02 03:00:00").alias("window"),
        columns.day_before("2026-03-01").cast("string").alias("before"),
    ).first()
    assert (row.key, float(row.pct), row.undefined) == (4, 33.3, None)
    assert (row.window, row.before) == ("2026-05-01", "2026-02-28")
    audited = columns.with_audit(df, "2026-01-02 03:04:05").first()
    assert audited.silver_loaded_ts == datetime(2026, 1, 2, 3, 4, 5)
    typed = columns.with_constants(df, {"c": (None, "string"), "d": ("2026-01-01", "date")})
    assert dict(typed.dtypes)["c"] == "string" and dict(typed.dtypes)["d"] == "date"


def test_reconcile_and_duplicates(spark, rows):
    bronze = trades(spark, SEED + SEED[:1])
    silver = conform.silver_trades(bronze)
    result = {str(r.trade_date): tuple(r)[1:] for r in reconcile.reconcile(bronze, silver).collect()}
    assert result["2026-05-01"] == (4, 3, 1) and result["2026-05-06"] == (1, 0, 1)
    assert rows(reconcile.duplicate_keys(bronze, ["trade_id"])) == [(100001, 2)]


def test_profile_counts_nulls_and_sums(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    out = {r.column_name: r for r in reconcile.profile(df).collect()}
    assert (out["n"].row_count, out["n"].null_count, out["n"].column_sum) == (2, 0, D("3.0000"))
    assert out["s"].null_count == 1 and out["s"].column_sum is None


def test_profile_keeps_small_parts_and_tells_what_it_left_out(spark):
    rows = [(0.00004, D("0.00001")), (0.00004, D("0.00009")), (0.00004, None), (float("nan"), None)]
    df = spark.createDataFrame(rows, "x double, d decimal(18,5)")
    out = {r.column_name: r for r in reconcile.profile(df).collect()}
    assert (out["x"].column_sum, out["x"].unsummed_count) == (D("0.0001"), 1)
    assert (out["d"].column_sum, out["d"].unsummed_count, out["d"].null_count) == (D("0.0001"), 0, 2)


def test_relate_refuses_repeats_and_agrees_on_both_paths(spark, rows):
    fact = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "k int, v int")
    dim = spark.createDataFrame([(1, "a"), (3, "c")], "k int, name string")
    for how in ("inner", "left"):
        assert rows(joins.relate(fact, dim, "k", how)) == rows(joins.relate(fact, dim, "k", how, 0))
    assert rows(joins.relate(fact, dim, "k")) == [(1, 5, "a")]
    assert rows(joins.relate(fact, dim.limit(0), "k")) == []
    with pytest.raises(ValueError, match="not unique"):
        joins.relate(fact, dim.union(dim), "k")
