from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixtures import JANUARY, traders, trades
from ledgerlake.functions import calendar
from ledgerlake.operators import conform, gold, joins, measures, ranking, reconcile
from ledgerlake.plans.blotter import Blotter
from ledgerlake.plans.queries import QUERIES
from ledgerlake.sinks import tables as sinks

SECURITIES = [(1, "Equity"), (2, "Equity"), (3, "Fixed Income")]


def small_star(spark):
    """Four trades with a known star-query result (fixed values)."""
    raw = [
        (100001, "2026-05-01", 1, 1, "BUY", "5000", "1550.25", "2026-05-01 10:00:00"),
        (100002, "2026-05-01", 2, 1, "SELL", "2000", "1625.50", "2026-05-01 10:00:00"),
        (100003, "2026-05-04", 3, 2, "BUY", "100000", "98.75", "2026-05-04 10:00:00"),
        (100004, "2026-05-29", 1, 1, "BUY", "1200", "1580.00", "2026-05-29 10:00:00"),
    ]
    fact = conform.silver_trades(trades(spark, raw))
    securities = spark.createDataFrame(SECURITIES, "security_id long, asset_class string")
    return fact, calendar.calendar(spark, "2026-05-01", "2026-05-31"), securities


def test_star_query(spark):
    fact, days, securities = small_star(spark)
    result = ranking.by_measure(
        gold.traded_value_by_month(fact, days, securities), "total_traded_value"
    ).collect()
    assert [tuple(r) for r in result] == [
        ("May", 2026, "Fixed Income", "BUY", D("9875000.00"), 1),
        ("May", 2026, "Equity", "BUY", D("9647250.00"), 2),
        ("May", 2026, "Equity", "SELL", D("3251000.00"), 1),
    ]


def test_calendar_marks_the_last_business_day(spark):
    days = {r.full_date: r for r in calendar.calendar(spark, "2026-05-01", "2026-06-30").collect()}
    assert [d for d, r in days.items() if r.is_month_end] == [date(2026, 5, 29), date(2026, 6, 30)]
    first = days[date(2026, 5, 1)]
    assert tuple(first)[:6] == (20260501, date(2026, 5, 1), "Friday", "May", 2, 2026)


def test_business_days(spark):
    found = [r.full_date for r in calendar.business_days(spark, "2026-05-01", 31).collect()]
    assert len(found) == 31 and found[0] == date(2026, 5, 1) and found[1] == date(2026, 5, 4)
    assert all(d.weekday() < 5 for d in found) and found[-1] == date(2026, 6, 12)


def test_gold_by_asset_is_the_same_for_small_and_large_dimensions(spark, rows):
    fact, _, securities = small_star(spark)
    by_broadcast = gold.gold_by_asset(fact, securities)
    by_shuffle = gold.gold_by_asset(fact, securities, limit=0)
    assert rows(by_broadcast) == rows(by_shuffle)
    assert by_broadcast.where("asset_class = 'Fixed Income'").first().avg_price == D("98.75")


def test_enrich_keeps_the_number_of_rows(spark):
    fact, _, securities = small_star(spark)
    only_two = securities.where("security_id < 3")
    for limit in (0, joins.BROADCAST_LIMIT):
        rich = joins.enrich(fact, {"security_id": only_two}, limit=limit)
        assert rich.count() == 4
        assert rich.where("asset_class is null").count() == 1


def test_broadcast_only_below_the_measured_limit(spark):
    fact, _, securities = small_star(spark)
    size, none = joins.measured_bytes(securities, securities.where('false'))
    assert none == 0
    assert size == 3 * 32 + len("Equity") * 2 + len("Fixed Income")
    assert joins.small(securities, size) and not joins.small(securities, size - 1)


def test_flagged_share_leaves_out_groups_without_a_flag(spark, rows):
    df = spark.createDataFrame(
        [("a", D(60)), ("a", D(40)), ("b", D(5))], "desk string, trade_value decimal(18,2)"
    )
    assert rows(gold.flagged_share(df, 50)) == [("a", D("60.00"), D("100.00"), D("60.0"))]
    summary = rows(gold.review_summary(df, 50))
    assert summary == [
        ("a", False, D("40.00"), 1),
        ("a", True, D("60.00"), 1),
        ("b", False, D("5.00"), 1),
    ]


def test_month_total_needs_the_year_too(spark):
    df = spark.createDataFrame(
        [(date(2026, 5, 1), D(1)), (date(2026, 5, 31), D(2)), (date(2025, 5, 9), D(4))],
        "trade_date date, total_trade_value decimal(28,2)",
    )
    assert gold.month_total(df, 2026, 5).first()[0] == D("3.00")


def test_totals_by_each_column(spark, rows):
    df = spark.createDataFrame(
        [("x", "p", D(1)), ("x", "q", D(2)), (None, "q", D(4))],
        "desk string, kind string, trade_value decimal(18,2)",
    )
    assert rows(gold.totals_by_each(df, ["desk", "kind"])) == [
        ("desk", None, D("4.00"), 1),
        ("desk", "x", D("3.00"), 2),
        ("kind", "p", D("1.00"), 1),
        ("kind", "q", D("6.00"), 2),
    ]


def test_parts_sum_to_the_whole(spark):
    df = spark.createDataFrame([(1, D(1)), (2, D(2)), (2, D(3))], "trader_id int, v decimal(18,2)")
    assert reconcile.audit_parts(df, "trader_id", "v").first().agrees
    orphan = df.union(spark.createDataFrame([(None, D(9))], df.schema))
    result = reconcile.audit_parts(orphan, "trader_id", "v").first()
    assert (result.rows_in_parts, result.rows_in_whole, result.agrees) == (3, 4, False)

    def audited(*logins):
        mapping = spark.createDataFrame(logins, "trader_id int, login_name string")
        return reconcile.audit_parts(df, "trader_id", "v", mapping).first()

    assert audited((1, "a"), (2, "b"), (2, "b")).agrees
    assert audited((1, "a")).rows_in_parts == 1
    assert audited((1, "a"), (2, "b"), (2, "c")).rows_in_parts == 5


def test_totals_within_tolerance(spark):
    a = spark.createDataFrame([(D("10.00"),)], "v decimal(18,2)")
    b = spark.createDataFrame([(D("10.01"),)], "v decimal(18,2)")
    assert not reconcile.reconcile_totals(a, b, "v", "v").first().agrees
    assert reconcile.reconcile_totals(a, b, "v", "v", D("0.01")).first().agrees


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "k string, m int")
    assert [r.k for r in ranking.top_n(df, 2, "m", ["k"]).collect()] == ["a", "b"]
    assert ranking.top_row(df, "m", ["k"]).first().k == "a"
    assert ranking.preview(df, 5, "m = 0").count() == 1


def test_relationship_refuses_a_repeated_key(spark):
    fact, _, securities = small_star(spark)
    with pytest.raises(ValueError):
        joins.relate(fact, securities.union(securities), "security_id")


def test_measure_and_control_total(spark):
    fact, _, _ = small_star(spark)
    daily = gold.gold_daily(fact)
    model = joins.relate(daily, traders(spark, JANUARY), "trader_id")
    total = measures.measure(model, "Total Trade Value")
    measures.assert_total(total, "Total Trade Value", D("22773250.00"))
    with pytest.raises(AssertionError):
        measures.assert_total(total, "Total Trade Value", D(1))
    by_desk = measures.measure(model, ["Trade Count"], by=["desk"], where=F.col("desk") != "Macro")
    assert {r.desk: r["Trade Count"] for r in by_desk.collect()} == {"Equities": 3, "Credit": 1}


def test_skewed_key_is_split_by_adaptive_execution(spark):
    """A fact with a third of its rows on one key, joined to a dimension past the limit."""
    keys = ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.enabled",
            "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ("20KB", "1.5", "20KB", "false", "-1")):
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        fact = spark.range(0, 60000, 1, 6).select(hot.alias("k"), F.col("id").alias("v"))
        dim = spark.range(60000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("g"))
        joined = joins.enrich(fact, {"k": dim}, limit=0)
        assert joined.count() == 60000
        result = joined.select("k", "v", "g")
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def jobs_of(spark, monkeypatch, name):
    """The query's rows, and how often Bronze was asked for on the way."""
    steps, build = [], Blotter.bronze
    write = sinks.write_parquet
    monkeypatch.setattr(Blotter, "bronze", lambda b: steps.append("bronze") or build(b))
    monkeypatch.setattr(sinks, "write_parquet", lambda *a: steps.append("stored") or write(*a))
    result = QUERIES[name](spark, "/root/testdata/sf0.001")
    return result, steps


def test_control_total_computes_silver_once(spark, monkeypatch):
    result, steps = jobs_of(spark, monkeypatch, "control_total")
    assert steps == ["bronze", "stored", "stored"]  # Silver, then the total held against it
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "lineitem" not in plan


def test_preview_shows_the_trade_it_looked_up(spark, monkeypatch):
    silver = Blotter(spark, "/root/testdata/sf0.001").silver()
    last = silver.orderBy(F.desc("trade_id")).select("trade_id", "trader_id", "trade_type").first()
    result, _ = jobs_of(spark, monkeypatch, "preview_rows")
    assert [tuple(r) for r in result.collect()] == [(*last, 5, True, 5)]
