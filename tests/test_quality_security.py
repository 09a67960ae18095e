from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixtures import JANUARY, SEED, traders, trades
from ledgerlake.operators import conform, gold, joins, quality, security
from ledgerlake.schemas import LOGINS

LOGIN_ROWS = [(i, f"user{i}@example.com") for i in range(1, 7)]


def tables(spark, raw=SEED):
    bronze = trades(spark, raw)
    silver = conform.silver_trades(bronze)
    dim = traders(spark, JANUARY)
    return {
        "bronze_trades": bronze,
        "silver_trades": silver,
        "gold_fact_trades_daily": gold.gold_daily(silver),
        "gold_dim_trader": dim,
        "dim_trader": dim,
    }


def test_single_checks(spark, rows):
    df = spark.createDataFrame(
        [(1, "BUY", D(1)), (1, "SEL", D(0)), (None, None, None), (None, "BUY", D(-1))],
        "id int, side string, q decimal(18,2)",
    )
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert quality.not_null(df, "id").count() == 2
    assert rows(quality.accepted_values(df, "side", ["BUY", "SELL"])) == [("SEL", 1)]
    assert quality.positive_value(df, "q").count() == 2
    parent = spark.createDataFrame([(5,)], "pk int")
    assert quality.relationships(df, "id", parent, "pk").count() == 2
    assert quality.expression_check(df, "q < 0").count() == 1


def test_suite_reports_every_check(spark):
    results = quality.run_checks(tables(spark), quality.blotter_suite()).collect()
    assert len(results) == 11
    failed = [r for r in results if not r.passed]
    assert [(r.check_name, r.failing_rows) for r in failed] == [
        ("bronze_trades_positive_quantity_and_price", 1)
    ]


def test_gate_publishes_unless_an_error_failed(spark):
    done = []
    quality.gate(tables(spark), quality.blotter_suite(), lambda: done.append(1))
    assert done == [1]
    wrong = [*SEED, (5, "2026-05-06", 1, 1, "SEL", "1", "1", "2026-05-06 10:00:00")]
    with pytest.raises(quality.ChecksFailed) as caught:
        quality.gate(tables(spark, wrong), quality.blotter_suite(), lambda: done.append(2))
    assert [r.failing_rows for r in caught.value.failed] == [1] and done == [1]


def test_failures_can_be_stored(spark, rows, tmp_path):
    from ledgerlake.sinks.tables import store_failures

    check = quality.blotter_suite()[-1]
    failing = check.failing(tables(spark))
    stored = store_failures(spark, failing, "failed_bronze", str(tmp_path / "failed"))
    assert rows(stored, "trade_id") == [(100010,)]
    spark.sql("drop table failed_bronze")


def test_row_filter(spark):
    t, logins = tables(spark), spark.createDataFrame(LOGIN_ROWS, LOGINS)
    silver, dim = t["silver_trades"], t["dim_trader"]

    def seen(who):
        return security.row_filter(silver, logins, who, {"admin"}).count()

    assert (seen("user1@example.com"), seen("admin"), seen("nobody")) == (4, 9, 0)
    via = security.row_filter_via_dim(silver, dim, logins, "user1@example.com", {"admin"})
    assert via.count() == 4
    assert security.row_filter(dim, logins, "user1@example.com").count() == 1
    assert security.group_filter(silver, dim, "desk = 'Credit'").count() == 2
    assert security.row_filter(silver, logins, None).count() == 0  # session user is not mapped


def test_visible_rows_add_up(spark):
    t, logins = tables(spark), spark.createDataFrame(LOGIN_ROWS, LOGINS)
    report = security.visibility_report(
        t["silver_trades"], logins, "trader_id", "trade_value", "admin"
    ).collect()
    rows = {r.login_name: r.visible_rows for r in report}
    assert rows.pop("admin") == sum(rows.values()) == 9


def test_live_and_frozen(spark, tmp_path):
    silver = tables(spark)["silver_trades"]
    live = security.live_totals(silver, security.own_rows(1))
    assert sum(r.trade_count for r in live.collect()) == 4
    frozen = security.frozen_extract(silver, security.own_rows(None), str(tmp_path / "x"), spark)
    assert sum(r.trade_count for r in frozen.collect()) == 9


def test_visibility_function(spark):
    spark.createDataFrame(LOGIN_ROWS, LOGINS).createOrReplaceTempView("login_map")
    tables(spark)["silver_trades"].createOrReplaceTempView("silver_for_login")
    security.create_visibility_function(spark, "may_see", "login_map")
    sql = "select count(*) from silver_for_login s, lateral may_see(s.trader_id, :who)"
    assert spark.sql(sql, args={"who": "user1@example.com"}).first()[0] == 4
    assert spark.sql(sql, args={"who": "nobody"}).first()[0] == 0


def test_null_keys_are_kept_by_drop_keys(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    keys = spark.createDataFrame([(1,)], "k int")
    assert joins.drop_keys(df, keys, ["k"]).count() == 2
    assert joins.keep_keys(df, keys, ["k"]).count() == 1
    assert df.where(F.col("k").isNull()).count() == 1


def test_secured_view_follows_the_session_user(spark):
    user = spark.sql("select session_user()").first()[0]
    spark.createDataFrame([(1, user), (2, "someone")], LOGINS).createOrReplaceTempView("view_map")
    tables(spark)["silver_trades"].createOrReplaceTempView("silver_for_view")
    security.create_secured_view(spark, "mine", "silver_for_view", "view_map", "admin")
    assert spark.table("mine").count() == 4
    security.create_secured_view(spark, "all_rows", "silver_for_view", "view_map", user)
    assert spark.table("all_rows").count() == 9


def test_build_stores_checked_layers_and_keeps_history(spark, tmp_path):
    from fixtures import JUNE
    from ledgerlake.plans import medallion

    lake = str(tmp_path / "lake")
    first = medallion.build(spark, trades(spark), traders(spark, JANUARY), lake, "2026-01-01")
    assert (first.silver.count(), first.history.count(), len(first.checks)) == (9, 6, 11)
    for _ in range(2):
        june = medallion.build(spark, trades(spark), traders(spark, JUNE), lake, "2026-06-01")
        assert (june.history.count(), june.history.where("is_current").count()) == (10, 7)
    lost = traders(spark, JANUARY[1:])  # trades of a trader the dimension lacks
    with pytest.raises(quality.ChecksFailed):
        medallion.build(spark, trades(spark), lost, lake, "2026-07-01")
    path = f"{lake}/gold_dim_trader_scd2"
    assert spark.read.parquet(path).count() == 10


def test_the_sessions_own_user_may_be_admin(spark):
    me = spark.range(1).select(F.session_user()).first()[0]
    fact = spark.createDataFrame([(1,), (2,), (3,)], "trader_id long")
    logins = spark.createDataFrame([(2, "it's")], "trader_id long, login_name string")
    assert security.row_filter(fact, logins, None, {me}).count() == 3
    assert security.row_filter_via_dim(fact, fact, logins, None, {me}).count() == 3
    assert security.row_filter(fact, logins, None, {"other"}).count() == 0
    logins.createOrReplaceTempView("quoted_logins")
    fact.createOrReplaceTempView("quoted_fact")
    security.create_visibility_function(spark, "sees", "quoted_logins", ["o'admin"])
    query = "select f.trader_id from quoted_fact f, lateral sees(f.trader_id, {who})"
    assert spark.sql(query.format(who="\"o'admin\"")).count() == 3
    assert spark.sql(query.format(who="\"it's\"")).count() == 1
    security.create_secured_view(spark, "nobody", "quoted_fact", "quoted_logins", "' or 1=1 --")
    assert spark.table("nobody").count() == 0
