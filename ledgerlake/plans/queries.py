"""Every registered query, next to the SQL it is checked against.

Results are shown in types that print alike in both engines: money as double, dates as
text, missing text as 'none'. The operators themselves keep decimals, dates and NULLs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.functions import calendar, columns
from ledgerlake.operators import (
    conform,
    gold,
    history,
    joins,
    measures,
    quality,
    ranking,
    reconcile,
    security,
    upsert,
)
from ledgerlake.plans import medallion, windows
from ledgerlake.plans.blotter import (
    AMENDMENT_DATE,
    FIRST_BATCH,
    LOAD_DATE,
    REVIEW_LIMIT,
    SECOND_BATCH,
    Blotter,
)
from ledgerlake.plans.blotter_sql import with_views
from ledgerlake.session import work_folder
from ledgerlake.sinks import tables as sinks
from ledgerlake.sources import files
from ledgerlake.sources import tables as catalog
from ledgerlake.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TS = "1998-01-05 03:00:00"  # a scheduled run; its window is the day before


def shown(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            c = F.coalesce(c.cast("string"), F.lit("none"))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit("none"))
        out.append(c.alias(f.name))
    return df.select(out)


def query(name: str, *views: str, sql: str | None = None):
    """Register a function of the blotter under a name, with its SQL."""

    def register(build: Callable[[Blotter], DataFrame]):
        QUERIES[name] = lambda spark, folder: shown(build(Blotter(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return build

    return register


# --- Bronze to Silver -----------------------------------------------------------------

SILVER_COLUMNS = """trade_id, cast(trade_date as varchar) as trade_date, security_id, trader_id,
    trade_type, cast(quantity as double) as quantity, cast(price as double) as price"""


@query(
    "silver_trades",
    "silver_trades",
    sql=f"select {SILVER_COLUMNS}, cast(trade_value as double) as trade_value from silver_trades",
)
def _(b: Blotter):
    return b.silver()


@query(
    "rejected_trades",
    "newest_trades",
    sql=f"""select {SILVER_COLUMNS},
                   case when quantity > 0 then 'price' else 'quantity' end as reason
            from newest_trades where not (quantity > 0 and price > 0)""",
)
def _(b: Blotter):
    return conform.rejected_trades(b.bronze()).drop("last_modified_ts")


@query(
    "distinct_trade_lines",
    "bronze_trades",
    sql="""select trade_type, count(*) as distinct_rows
           from (select distinct trade_date, security_id, trader_id, trade_type
                 from bronze_trades) as d group by trade_type""",
)
def _(b: Blotter):
    rows = b.bronze().select("trade_date", "security_id", "trader_id", "trade_type")
    distinct = conform.distinct_rows(rows)
    return distinct.groupBy("trade_type").agg(F.count("*").alias("distinct_rows"))


@query(
    "staged_trades",
    "bronze_trades",
    sql=f"""select {SILVER_COLUMNS}, cast(last_modified_ts as varchar) as last_modified_ts
           from bronze_trades""",
)
def _(b: Blotter):
    """Every row, cell by cell, after a way through text."""
    text = b.bronze().select([F.col(c).cast("string").alias(c) for c in schemas.TRADES.names])
    return columns.staged(text, schemas.TRADES, strict=False)


@query(
    "bronze_silver_reconcile",
    "bronze_trades",
    "silver_trades",
    sql="""select cast(trade_date as varchar) as trade_date, cast(sum(b) as bigint)
                      as bronze_row_count,
                  cast(sum(s) as bigint) as silver_row_count,
                  cast(sum(b) - sum(s) as bigint) as removed_row_count
           from (select trade_date, 1 as b, 0 as s from bronze_trades
                 union all select trade_date, 0, 1 from silver_trades) as u
           group by trade_date""",
)
def _(b: Blotter):
    return reconcile.reconcile(b.bronze(), b.silver())


@query(
    "duplicate_keys",
    "bronze_trades",
    sql="""select trade_id, count(*) as n_records from bronze_trades
           group by trade_id having count(*) > 1""",
)
def _(b: Blotter):
    return reconcile.duplicate_keys(b.bronze(), ["trade_id"])


# --- star joins and Gold --------------------------------------------------------------

DAILY = """cast(trade_date as varchar) as trade_date, trader_id, trade_type,
    cast(total_trade_value as double) as total_trade_value, trade_count"""


@query("gold_daily", "gold_daily", sql=f"select {DAILY} from gold_daily")
def _(b: Blotter):
    return b.gold()


BY_ASSET = """select cast(trade_date as varchar) as trade_date, asset_class, trade_type,
    cast(sum(trade_value) as double) as total_trade_value, count(*) as trade_count,
    cast((2 * sum(cast(price * 10000 as bigint)) + 100 * count(*)) // (200 * count(*)) as double)
        / 100 as avg_price
    from silver_trades left join dim_security using (security_id)
    group by trade_date, asset_class, trade_type"""


@query("gold_by_asset", "silver_trades", "dim_security", sql=BY_ASSET)
def _(b: Blotter):
    return gold.gold_by_asset(b.silver(), b.securities())


@query("gold_by_asset_large_dim", "silver_trades", "dim_security", sql=BY_ASSET)
def _(b: Blotter):
    return gold.gold_by_asset(b.silver(), b.securities(), limit=0)


@query(
    "gold_regrouped",
    "silver_trades",
    "dim_security",
    sql="""select asset_class, trade_type, cast(sum(trade_value) as double) as grand_total,
                  count(*) as trades
           from silver_trades left join dim_security using (security_id)
           group by asset_class, trade_type""",
)
def _(b: Blotter):
    gold.gold_by_asset(b.silver(), b.securities()).createOrReplaceTempView("gold_trades_daily")
    return b.spark.sql(
        """SELECT asset_class, trade_type, sum(total_trade_value) AS grand_total,
                  sum(trade_count) AS trades
           FROM gold_trades_daily GROUP BY asset_class, trade_type"""
    )


@query(
    "value_by_month",
    "silver_trades",
    "dim_security",
    sql="""select monthname(trade_date) as month_name, cast(year(trade_date) as int) as year,
                  asset_class, trade_type, cast(sum(trade_value) as double) as total_traded_value,
                  count(*) as trade_count
           from silver_trades join dim_security using (security_id)
           group by monthname(trade_date), year(trade_date), asset_class, trade_type""",
)
def _(b: Blotter):
    days = calendar.calendar_of(b.table("orders"), "o_orderdate")
    return gold.traded_value_by_month(b.silver(), days, b.securities())


# fixed values: the currency each region trades in
CURRENCIES = [
    ("AFRICA", "ZAR"),
    ("AMERICA", "USD"),
    ("ASIA", "JPY"),
    ("EUROPE", "EUR"),
    ("MIDDLE EAST", "AED"),
]


@query(
    "value_by_month_and_currency",
    "silver_trades",
    "dim_security",
    "dim_trader",
    sql="""select monthname(trade_date) as month_name, cast(year(trade_date) as int) as year,
                  asset_class, trade_type, currency_code,
                  cast(sum(trade_value) as double) as total_traded_value, count(*) as trade_count
           from silver_trades join dim_security using (security_id)
           join dim_trader using (trader_id)
           join (values ('AFRICA','ZAR'), ('AMERICA','USD'), ('ASIA','JPY'), ('EUROPE','EUR'),
                        ('MIDDLE EAST','AED')) as c(region, currency_code) using (region)
           group by all""",
)
def _(b: Blotter):
    schema = T.StructType(
        [T.StructField("region", T.StringType()), T.StructField("currency_code", T.StringType())]
    )
    return gold.traded_value_by_month(
        b.silver(),
        calendar.calendar_of(b.table("orders"), "o_orderdate"),
        b.securities(),
        extra=["currency_code"],
        extra_dims={
            "trader_id": b.traders().select("trader_id", "region"),
            "region": F.broadcast(catalog.inline_rows(b.spark, CURRENCIES, schema)),
        },
    )


@query(
    "enriched_trades",
    "silver_trades",
    "dim_security",
    "dim_trader",
    sql="""select trade_id, ticker, asset_class, trader_name, desk, region,
                  cast(trade_value as double) as trade_value
           from silver_trades left join dim_security using (security_id)
           left join dim_trader using (trader_id)""",
)
def _(b: Blotter):
    rich = joins.enrich(b.silver(), {"security_id": b.securities(), "trader_id": b.traders()})
    return rich.select(
        "trade_id", "ticker", "asset_class", "trader_name", "desk", "region", "trade_value"
    )


@query(
    "totals_by_side",
    "silver_trades",
    sql="""select cast(trade_date as varchar) as trade_date, trade_type,
                  cast(sum(trade_value) as double) as total_value, count(*) as trade_count
           from silver_trades group by trade_date, trade_type""",
)
def _(b: Blotter):
    return gold.totals(b.silver(), ["trade_date", "trade_type"], total="total_value")


@query(
    "value_by_desk_and_asset",
    "silver_trades",
    "dim_security",
    "dim_trader",
    sql="""select 'desk' as grouped_by, desk as member,
                  cast(sum(trade_value) as double) as total_trade_value, count(*) as trade_count
           from silver_trades left join dim_trader using (trader_id) group by desk
           union all
           select 'asset_class', asset_class, cast(sum(trade_value) as double), count(*)
           from silver_trades left join dim_security using (security_id) group by asset_class""",
)
def _(b: Blotter):
    rich = joins.enrich(b.silver(), {"security_id": b.securities(), "trader_id": b.traders()})
    return gold.totals_by_each(rich, ["desk", "asset_class"])


@query(
    "desk_review_summary",
    "silver_trades",
    "dim_trader",
    sql=f"""select desk, trade_value > {REVIEW_LIMIT} as needs_review,
                   cast(sum(trade_value) as double) as total_trade_value,
                   count(*) as flagged_trade_count
            from silver_trades left join dim_trader using (trader_id)
            group by desk, trade_value > {REVIEW_LIMIT}""",
)
def _(b: Blotter):
    rich = joins.enrich(b.silver(), {"trader_id": b.traders()})
    return gold.review_summary(rich, REVIEW_LIMIT)


def _share_sql(keys: str, shown_keys: str) -> str:
    over = f"sum(case when trade_value > {REVIEW_LIMIT} then trade_value end)"
    return f"""select {shown_keys}, cast({over} as double) as flagged_value,
                      cast(sum(trade_value) as double) as group_total_value,
                      round(cast({over} as double) / cast(sum(trade_value) as double) * 100, 1)
                          as pct_of_group_total
               from silver_trades left join dim_trader using (trader_id)
               group by {keys} having {over} is not null"""


@query("flagged_share", "silver_trades", "dim_trader", sql=_share_sql("desk", "desk"))
def _(b: Blotter):
    rich = joins.enrich(b.silver(), {"trader_id": b.traders()})
    return gold.flagged_share(rich, REVIEW_LIMIT)


@query(
    "flagged_share_by_day",
    "silver_trades",
    "dim_trader",
    sql=_share_sql("trade_date, desk", "cast(trade_date as varchar) as trade_date, desk"),
)
def _(b: Blotter):
    rich = joins.enrich(b.silver(), {"trader_id": b.traders()})
    return gold.flagged_share(rich, REVIEW_LIMIT, by=["trade_date", "desk"])


@query(
    "top_flagged_desk",
    "silver_trades",
    "dim_trader",
    sql=_share_sql("desk", "desk") + " order by flagged_value desc, desk limit 1",
)
def _(b: Blotter):
    rich = joins.enrich(b.silver(), {"trader_id": b.traders()})
    return ranking.top_row(gold.flagged_share(rich, REVIEW_LIMIT), "flagged_value", ["desk"])


@query(
    "notional_by_date",
    "bronze_trades",
    sql="""select cast(trade_date as varchar) as trade_date, count(*) as row_count,
                  cast(sum(quantity * price) as decimal(28,2))::double as gross_notional
           from bronze_trades group by trade_date""",
)
def _(b: Blotter):
    return gold.notional_by_date(b.bronze())


@query(
    "top_n_gold",
    "gold_daily",
    sql=f"""select {DAILY} from gold_daily
            order by gold_daily.total_trade_value desc, gold_daily.trade_date, trader_id,
                     trade_type limit 10""",
)
def _(b: Blotter):
    return ranking.top_n(
        b.gold(), 10, "total_trade_value", ["trade_date", "trader_id", "trade_type"]
    )


@query(
    "gold_ordered",
    "gold_daily",
    sql="""select trader_id, cast(sum(total_trade_value) as double) as total_trade_value
           from gold_daily group by trader_id order by 2 desc""",
)
def _(b: Blotter):
    per_trader = b.gold().groupBy("trader_id").agg(
        gold.total_of("total_trade_value").alias("total_trade_value")
    )
    return ranking.by_measure(per_trader, "total_trade_value")


@query(
    "grand_total",
    "silver_trades",
    sql="select cast(sum(trade_value) as double) as total_trade_value from silver_trades",
)
def _(b: Blotter):
    return gold.grand_total(b.gold())


@query(
    "gold_by_date_then_value",
    "gold_daily",
    sql=f"select {DAILY} from gold_daily order by 1, 4 desc",
)
def _(b: Blotter):
    return ranking.by_measure(b.gold(), "total_trade_value", first=["trade_date"])


@query(
    "month_total",
    "silver_trades",
    sql="""select cast(sum(trade_value) as double) as total_trade_value from silver_trades
           where year(trade_date) = 1998 and month(trade_date) = 5""",
)
def _(b: Blotter):
    return gold.month_total(b.gold(), 1998, 5)


@query(
    "calendar_dim",
    sql="""with ends as (select min(cast(o_orderdate as date)) as a,
                                max(cast(o_orderdate as date)) as z from orders),
           days as (select cast(unnest(generate_series(a, z, interval 1 day)) as date) as d
                    from ends)
           select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as varchar) as full_date,
                  dayname(d) as day_name, monthname(d) as month_name,
                  cast(quarter(d) as int) as quarter, cast(year(d) as int) as year,
                  d = last_day(d) - cast(greatest(isodow(last_day(d)) - 5, 0) as int)
                      as is_month_end
           from days""",
)
def _(b: Blotter):
    return calendar.calendar_of(b.table("orders"), "o_orderdate")


@query(
    "business_day_list",
    sql="""with ends as (select min(cast(o_orderdate as date)) as a,
                                max(cast(o_orderdate as date)) as z from orders),
           days as (select cast(unnest(generate_series(a, z, interval 1 day)) as date) as d
                    from ends)
           select cast(d as varchar) as full_date, dayname(d) as day_name
           from days where isodow(d) < 6""",
)
def _(b: Blotter):
    days = calendar.calendar_of(b.table("orders"), "o_orderdate")
    return days.where(calendar.is_business_day(F.col("full_date"))).select("full_date", "day_name")


@query(
    "first_business_days",
    sql="""with start as (select min(cast(o_orderdate as date)) as a from orders),
           days as (select cast(unnest(generate_series(a, a + 60, interval 1 day)) as date) as d
                    from start)
           select cast(d as varchar) as full_date from days where isodow(d) < 6
           order by d limit 30""",
)
def _(b: Blotter):
    """The thirty business days from the first order on."""
    start = b.table("orders").agg(F.min("o_orderdate").cast("date")).first()[0]
    return calendar.business_days(b.spark, start, 30)


@query(
    "preview_rows",
    "silver_trades",
    sql="""select trade_id, trader_id, trade_type, n, all_known, n_different
           from silver_trades,
                (select least(count(*), 5) as n, true as all_known,
                        least(count(*), 5) as n_different, max(trade_id) as last
                 from silver_trades) as f
           where trade_id = last""",
)
def _(b: Blotter):
    """The trade with the highest number, next to any five trades: how many they are, and
    whether each, with all its columns, is a trade of Silver."""
    silver = stored_once(b, b.silver(), "preview-silver")
    last = silver.agg(F.max("trade_id")).first()[0]
    looked_up = ranking.preview(silver, 5, F.col("trade_id") == last)
    found = stored_once(b, ranking.preview(silver, 5), "preview")
    alike = reduce(Column.__and__, [silver[c].eqNullSafe(found[c]) for c in silver.columns])
    known = silver.join(F.broadcast(found), alike, "left_semi")
    counts = found.agg(
        F.count("*").alias("n"),
        (F.count("*") == F.lit(known.count())).alias("all_known"),
        F.lit(found.distinct().count()).cast("bigint").alias("n_different"),
    )
    rows = looked_up.select("trade_id", "trader_id", "trade_type")
    return rows.crossJoin(F.broadcast(counts))


@query(
    "control_total",
    "gold_daily",
    "silver_trades",
    sql="""select cast(sum(total_trade_value) as double) as "Total Trade Value" from gold_daily""",
)
def _(b: Blotter):
    """The measure over Gold, after it was held against the total of Silver."""
    names = ["trade_date", "trader_id", "trade_type", "trade_value"]
    silver = stored_once(b, b.silver().select(*names), "control-silver")
    expected = silver.agg(gold.total_of("trade_value")).first()[0]
    total = measures.measure(gold.gold_daily(silver), "Total Trade Value")
    result = stored_once(b, total, "control-total")
    measures.assert_total(result, "Total Trade Value", expected)
    return result


def stored_once(b: Blotter, df: DataFrame, purpose: str) -> DataFrame:
    """Rows that several steps read, computed by the first."""
    path = work_folder(b.spark, purpose)
    sinks.write_parquet(df, path)
    return b.spark.read.schema(df.schema).parquet(path)


@query(
    "coalesced_keys",
    "first_book",
    "silver_trades",
    sql="""select coalesce(b.trade_id, s.trade_id) as trade_id, b.trader_id as booked_by,
                  s.trader_id as traded_by
           from first_book as b full join silver_trades as s on b.trade_id = s.trade_id""",
)
def _(b: Blotter):
    """One key out of both sides of a full outer join."""
    book = b.first_book().select(F.col("trade_id").alias("book_id"), F.col("trader_id").alias("booked_by"))
    silver = b.silver().select(F.col("trade_id").alias("silver_id"), F.col("trader_id").alias("traded_by"))
    both = book.join(silver, F.col("book_id") == F.col("silver_id"), "full_outer")
    return both.select(
        columns.first_present("book_id", "silver_id").alias("trade_id"), "booked_by", "traded_by"
    )


@query(
    "customers_with_orders",
    sql="""select c_mktsegment, count(*) as customers from customer
           where c_custkey in (select o_custkey from orders) group by c_mktsegment""",
)
def _(b: Blotter):
    buyers = b.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    kept = joins.keep_keys(b.table("customer"), buyers, ["c_custkey"])
    return kept.groupBy("c_mktsegment").agg(F.count("*").alias("customers"))


@query(
    "traders_with_rejected_trades",
    "newest_trades",
    "dim_trader",
    sql="""select trader_id, desk, trader_id in (select trader_id from newest_trades
                  where not (quantity > 0 and price > 0)) as has_rejects from dim_trader""",
)
def _(b: Blotter):
    rejects = conform.rejected_trades(b.bronze()).select("trader_id")
    dim = b.traders().select("trader_id", "desk")
    return history.assemble(
        joins.keep_keys(dim, rejects, ["trader_id"]).withColumn("has_rejects", F.lit(True)),
        joins.drop_keys(dim, rejects, ["trader_id"]).withColumn("has_rejects", F.lit(False)),
    )


@query(
    "business_day_trading",
    "silver_trades",
    sql="""select isodow(trade_date) < 6 as business_day, count(*) as trade_count,
                  cast(sum(trade_value) as double) as total_trade_value
           from silver_trades group by isodow(trade_date) < 6""",
)
def _(b: Blotter):
    flagged = b.silver().withColumn("business_day", calendar.is_business_day(F.col("trade_date")))
    return gold.totals(flagged, ["business_day"])


# --- quality ----------------------------------------------------------------------------


@query(
    "check_unique",
    sql="""select l_orderkey, l_linenumber, count(*) as n_records from lineitem
           group by l_orderkey, l_linenumber having count(*) > 1""",
)
def _(b: Blotter):
    return quality.unique(b.table("lineitem"), "l_orderkey", "l_linenumber")


@query(
    "check_not_null",
    "trader_states",
    sql="""select cast(snapshot_date as varchar) as snapshot_date, trader_id, trader_name, region
           from trader_states where desk is null""",
)
def _(b: Blotter):
    dated = [(LOAD_DATE, b.first_traders()), *b.trader_batches()]
    states = history.assemble(
        *[df.withColumn("snapshot_date", F.lit(d).cast("date")) for d, df in dated]
    )
    return quality.not_null(states, "desk").drop("desk")


@query(
    "check_accepted",
    sql="""select l_returnflag as value_field, count(*) as n_records from lineitem
           where l_returnflag not in ('A', 'N') group by l_returnflag""",
)
def _(b: Blotter):
    return quality.accepted_values(b.table("lineitem"), "l_returnflag", ["A", "N"])


@query(
    "check_relationships",
    "silver_trades",
    "trader_states",
    sql=f"""select trader_id, count(*) as orphans from silver_trades
            where trader_id is not null and trader_id not in
                  (select trader_id from trader_states where snapshot_date = date '{LOAD_DATE}')
            group by trader_id""",
)
def _(b: Blotter):
    orphans = quality.relationships(b.silver(), "trader_id", b.first_traders(), "trader_id")
    return orphans.groupBy("trader_id").agg(F.count("*").alias("orphans"))


@query(
    "check_positive",
    sql="select c_custkey, c_acctbal from customer where c_acctbal <= 0",
)
def _(b: Blotter):
    failing = quality.positive_value(b.table("customer"), "c_acctbal")
    return failing.select("c_custkey", "c_acctbal")


@query(
    "check_expression",
    "bronze_trades",
    sql="""select trade_id, cast(quantity as double) as quantity, cast(price as double) as price
           from bronze_trades where quantity <= 0 or price <= 0""",
)
def _(b: Blotter):
    bad = (F.col("quantity") <= 0) | (F.col("price") <= 0)
    return quality.expression_check(b.bronze(), bad).select("trade_id", "quantity", "price")


def _suite_tables(b: Blotter) -> dict[str, DataFrame]:
    """Layers as they are checked: Silver is built and stored before its checks read it."""
    stored = work_folder(b.spark, "silver")
    sinks.write_parquet(b.silver(), stored)
    silver = files.read_parquet(b.spark, stored)
    return {
        "bronze_trades": b.bronze(),
        "silver_trades": silver,
        "gold_fact_trades_daily": gold.gold_daily(silver),
        "gold_dim_trader": b.traders(),
        "dim_trader": b.traders(),
    }


@query(
    "check_suite",
    "bronze_trades",
    "silver_trades",
    "gold_daily",
    "dim_trader",
    sql="""
    select check_name, table_name, severity, failing_rows, failing_rows = 0 as passed from (
      select 'unique_dim_trader_trader_id' as check_name, 'dim_trader' as table_name,
             'error' as severity, (select count(*) from (select trader_id from dim_trader
               where trader_id is not null group by trader_id having count(*) > 1) as x)
             as failing_rows
      union all select 'not_null_dim_trader_trader_id', 'dim_trader', 'error',
             (select count(*) from dim_trader where trader_id is null)
      union all select 'unique_silver_trades_trade_id', 'silver_trades', 'error',
             (select count(*) from (select trade_id from silver_trades
               where trade_id is not null group by trade_id having count(*) > 1) as x)
      union all select 'not_null_silver_trades_trade_id', 'silver_trades', 'error',
             (select count(*) from silver_trades where trade_id is null)
      union all select 'accepted_values_silver_trades_trade_type', 'silver_trades', 'error',
             (select count(distinct trade_type) from silver_trades
              where trade_type not in ('BUY', 'SELL'))
      union all select 'positive_value_silver_trades_quantity', 'silver_trades', 'error',
             (select count(*) from silver_trades where quantity <= 0)
      union all select 'positive_value_silver_trades_price', 'silver_trades', 'error',
             (select count(*) from silver_trades where price <= 0)
      union all select 'relationships_gold_fact_trades_daily_trader_id',
             'gold_fact_trades_daily', 'error',
             (select count(*) from gold_daily where trader_id not in
               (select trader_id from dim_trader))
      union all select 'unique_gold_dim_trader_trader_id', 'gold_dim_trader', 'error',
             (select count(*) from (select trader_id from dim_trader
               where trader_id is not null group by trader_id having count(*) > 1) as x)
      union all select 'not_null_gold_dim_trader_trader_id', 'gold_dim_trader', 'error',
             (select count(*) from dim_trader where trader_id is null)
      union all select 'bronze_trades_positive_quantity_and_price', 'bronze_trades', 'warn',
             (select count(*) from bronze_trades where quantity <= 0 or price <= 0)
    ) as checks""",
)
def _(b: Blotter):
    """Bronze and Silver are counted by the write of Silver, which reads Bronze once."""
    suite, path = quality.blotter_suite(), work_folder(b.spark, "silver")
    of = {c.table: [x for x in suite if x.table == c.table] for c in suite}
    bronze, read = quality.watched(b.bronze(), of["bronze_trades"])
    silver, written = quality.watched(conform.silver_trades(bronze), of["silver_trades"])
    sinks.write_parquet(silver, path)
    stored = files.read_parquet(b.spark, path)
    results = quality.watched_results(read, of["bronze_trades"], {})
    results += quality.watched_results(written, of["silver_trades"], {"silver_trades": stored})
    tables = {"gold_dim_trader": b.traders(), "dim_trader": b.traders()}
    tables["gold_fact_trades_daily"] = gold.gold_daily(stored)
    rest = [c for c in suite if c.table in tables]
    counted = b.spark.createDataFrame(
        [tuple(r) for r in results],
        "check_name string, table_name string, severity string, failing_rows long, passed boolean",
    )
    return counted.union(quality.run_checks(tables, rest))


@query(
    "gated_gold",
    "silver_trades",
    "gold_daily",
    "dim_trader",
    sql="""select desk, cast(sum(total_trade_value) as double) as total_trade_value
           from gold_daily join dim_trader using (trader_id) group by desk""",
)
def _(b: Blotter):
    """Gold is published only after the suite passed on the layers below it."""
    tables, folder = _suite_tables(b), work_folder(b.spark, "gated")
    quality.gate(
        tables,
        quality.blotter_suite(),
        lambda: sinks.write_parquet(tables["gold_fact_trades_daily"], folder),
    )
    model = joins.relate(files.read_parquet(b.spark, folder), b.traders(), "trader_id")
    return model.groupBy("desk").agg(
        gold.total_of("total_trade_value").alias("total_trade_value")
    )


@query(
    "audit_parts",
    "silver_trades",
    "logins",
    sql="""select p.*, w.*, p.rows_in_parts = w.rows_in_whole
                  and p.value_in_parts = w.value_in_whole as agrees
           from (select count(distinct trader_id) as parts, count(*) as rows_in_parts,
                        cast(sum(trade_value) as double) as value_in_parts
                 from silver_trades join logins using (trader_id)) as p,
                (select count(*) as rows_in_whole,
                        cast(sum(trade_value) as double) as value_in_whole
                 from silver_trades) as w""",
)
def _(b: Blotter):
    return reconcile.audit_parts(b.silver(), "trader_id", "trade_value", b.logins())


@query(
    "gold_equals_silver",
    "gold_daily",
    "silver_trades",
    sql="""select cast(u as double) as upper_total, cast(l as double) as lower_total,
                  cast(abs(u - l) as double) as difference, abs(u - l) <= 0.01 as agrees
           from (select (select sum(total_trade_value) from gold_daily) as u,
                        (select sum(trade_value) from silver_trades) as l) as t""",
)
def _(b: Blotter):
    silver = b.silver()
    return reconcile.reconcile_totals(
        gold.gold_daily(silver), silver, "total_trade_value", "trade_value", 0.01
    )


def _profile_sql(table: str, described: list[tuple[str, str]]) -> str:
    lines = []
    for c, kind in described:
        total = (
            f"cast(sum(cast({c} as decimal(28,4))) as double)"
            if kind in ("int", "bigint", "double")
            else "cast(null as double)"
        )
        lines.append(
            f"select '{c}' as column_name, '{kind}' as column_type, count(*) as row_count,"
            f" count(*) - count({c}) as null_count, {total} as column_sum from {table}"
        )
    return " union all ".join(lines)


@query(
    "profile_orders",
    sql=_profile_sql(
        "orders",
        [
            ("o_orderkey", "bigint"),
            ("o_custkey", "bigint"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string"),
        ],
    ),
)
def _(b: Blotter):
    return reconcile.profile(b.table("orders")).drop("unsummed_count")


# --- history ----------------------------------------------------------------------------

TRADER_STATE = ["desk", "region"]
HISTORY_COLUMNS = """trader_id, trader_name, coalesce(desk, 'none') as desk, region,
    cast(valid_from as varchar)
    as valid_from, cast(valid_to as varchar) as valid_to, is_current"""


def trader_history(b: Blotter, batches: int = 2) -> DataFrame:
    first = history.scd2_init(b.first_traders(), LOAD_DATE)
    return history.scd2_fold(first, b.trader_batches()[:batches], "trader_id", TRADER_STATE)


@query(
    "history_first_run",
    "trader_states",
    sql=f"""select trader_id, trader_name, coalesce(desk, 'none') as desk, region,
                   '{LOAD_DATE}' as valid_from,
                   '9999-12-31' as valid_to, true as is_current
            from trader_states where snapshot_date = date '{LOAD_DATE}'""",
)
def _(b: Blotter):
    def first():
        return history.scd2_init(b.first_traders(), LOAD_DATE)

    name = work_folder(b.spark, "first_run").rsplit("/", 1)[-1].replace("-", "_")
    return catalog.read_or_init(b.spark, name, first)


@query(
    "scd2_changes",
    "trader_states",
    sql=f"""select n.trader_id, case when o.trader_id is null then 'new' else 'changed' end as kind
            from (select * from trader_states where snapshot_date = date '{FIRST_BATCH}') as n
            left join (select * from trader_states where snapshot_date = date '{LOAD_DATE}') as o
              on n.trader_id = o.trader_id
            where o.trader_id is null or n.desk is distinct from o.desk
               or n.region is distinct from o.region""",
)
def _(b: Blotter):
    now = history.current(history.scd2_init(b.first_traders(), LOAD_DATE))
    return history.scd2_changes(now, b.trader_batches()[0][1], "trader_id", TRADER_STATE)


@query(
    "scd2_one_batch", "trader_history_1", sql=f"select {HISTORY_COLUMNS} from trader_history_1"
)
def _(b: Blotter):
    return trader_history(b, batches=1)


@query(
    "scd2_step_by_step",
    "trader_history_1",
    sql=f"select {HISTORY_COLUMNS} from trader_history_1",
)
def _(b: Blotter):
    table = history.scd2_init(b.first_traders(), LOAD_DATE)
    date, snapshot = b.trader_batches()[0]
    now = history.current(table)
    changes = history.scd2_changes(now, snapshot, "trader_id", TRADER_STATE)
    return history.assemble(
        history.historical(table),
        history.scd2_keep(now, changes, "trader_id"),
        history.scd2_close(now, changes, "trader_id", date),
        history.scd2_open(snapshot, changes, "trader_id", date),
    )


@query("scd2_two_batches", "trader_history", sql=f"select {HISTORY_COLUMNS} from trader_history")
def _(b: Blotter):
    table = history.scd2_init(b.first_traders(), LOAD_DATE)
    for date, snapshot in b.trader_batches():
        table = history.scd2_apply(table, snapshot, "trader_id", TRADER_STATE, date)
        table = _cut(b, table)
    return table


@query("scd2_folded", "trader_history", sql=f"select {HISTORY_COLUMNS} from trader_history")
def _(b: Blotter):
    return trader_history(b)


@query("scd2_replayed_batch", "trader_history", sql=f"select {HISTORY_COLUMNS} from trader_history")
def _(b: Blotter):
    date, snapshot = b.trader_batches()[1]
    return history.scd2_apply(trader_history(b), snapshot, "trader_id", TRADER_STATE, date)


@query(
    "scd2_refused_late_batch",
    "trader_history",
    "trader_states",
    sql=f"""select s.trader_id, s.trader_name, coalesce(s.desk, 'none') as desk, s.region
            from (select * from trader_states where snapshot_date = date '{FIRST_BATCH}') as s
            join (select * from trader_history where is_current
                  and valid_from >= date '{FIRST_BATCH}') as h on s.trader_id = h.trader_id
            where s.desk is distinct from h.desk or s.region is distinct from h.region""",
)
def _(b: Blotter):
    date, snapshot = b.trader_batches()[0]
    return history.scd2_refused(trader_history(b), snapshot, "trader_id", TRADER_STATE, date)


@query(
    "user_state_history",
    "user_history",
    sql="""select user_id, state, cast(valid_from as varchar) as valid_from,
                  cast(valid_to as varchar) as valid_to,
                  valid_to = date '9999-12-31' as is_current
           from user_history""",
)
def _(b: Blotter):
    return history.scd2_from_snapshots(b.user_days(), "user_id", ["state"], "day")


@query(
    "as_of_dim",
    "trader_history",
    sql="""select trader_id, coalesce(desk, 'none') as desk, region from trader_history
           where date '1999-06-30' between valid_from and valid_to""",
)
def _(b: Blotter):
    at = joins.as_of(trader_history(b), "1999-06-30")
    return at.select("trader_id", "desk", "region")


@query(
    "history_integrity",
    "trader_history",
    sql="""select trader_id, count(*) as versions,
                  cast(sum(cast(is_current as int)) as bigint) as current_versions,
                  cast(0 as bigint) as wrong_versions, cast(2 as bigint) as loose_edges,
                  true as consistent
           from trader_history group by trader_id""",
)
def _(b: Blotter):
    return history.check_history(trader_history(b), "trader_id")


@query(
    "history_of_changed",
    "trader_history",
    sql=f"""select {HISTORY_COLUMNS} from trader_history where trader_id in
              (select trader_id from trader_history group by trader_id having count(*) > 1)
            order by trader_id, valid_from""",
)
def _(b: Blotter):
    table = trader_history(b)
    watched = history.historical(table).select("trader_id")
    return history.history_of(table, watched, "trader_id")


FACT_HISTORY = """
    select b.trade_id, b.trade_date, b.security_id, b.trader_id, b.trade_type, b.quantity,
           b.price, b.trade_value, date '{load}' as valid_from,
           case when {amended} then date '{batch}' - 1 else date '9999-12-31' end as valid_to,
           not ({amended}) as is_current, cast(null as varchar) as amendment_reason
    from first_book as b left join amendments as a on b.trade_id = a.trade_id
    union all
    select a.trade_id, a.trade_date, a.security_id, a.trader_id, a.trade_type, a.quantity,
           a.price, a.trade_value, date '{batch}', date '9999-12-31', true, a.amendment_reason
    from first_book as b join amendments as a on b.trade_id = a.trade_id where {amended}
""".format(
    load=LOAD_DATE,
    batch=AMENDMENT_DATE,
    amended="""a.trade_id is not null and (a.trade_date, a.security_id, a.trader_id,
        a.trade_type, a.quantity, a.price) is distinct from (b.trade_date, b.security_id,
        b.trader_id, b.trade_type, b.quantity, b.price)""",
)


def fact_history(b: Blotter) -> DataFrame:
    first = history.scd2_init(b.first_book(), LOAD_DATE).withColumn(
        "amendment_reason", F.lit(None).cast("string")
    )
    # a quarter of all trades is amended, so the batch is not even measured for broadcast
    return history.apply_amendments(first, b.amendments(), AMENDMENT_DATE, limit=0)


@query(
    "fact_amendments",
    "first_book",
    "amendments",
    sql=f"""select trade_id, cast(quantity as double) as quantity, cast(price as double) as price,
                   cast(trade_value as double) as trade_value,
                   cast(valid_from as varchar) as valid_from, cast(valid_to as varchar)
                       as valid_to, is_current,
                   coalesce(amendment_reason, 'none') as amendment_reason
            from ({FACT_HISTORY}) as h""",
)
def _(b: Blotter):
    return fact_history(b).drop("trade_date", "security_id", "trader_id", "trade_type")


@query(
    "unknown_amendments",
    "first_book",
    "amendments",
    sql="""select trade_id, cast(quantity as double) as quantity from amendments
           where trade_id not in (select trade_id from first_book)""",
)
def _(b: Blotter):
    book = history.scd2_init(b.first_book(), LOAD_DATE)
    unknown = history.unknown_amendments(book, b.amendments())
    return unknown.select("trade_id", "quantity")


@query(
    "trade_version_history",
    "bronze_trades",
    sql="""
    with days as (
      select *, cast(last_modified_ts as date) as modified from (
        select *, row_number() over (partition by trade_id, cast(last_modified_ts as date)
                 order by last_modified_ts desc, trade_date desc, security_id desc,
                          trader_id desc, trade_type desc, quantity desc, price desc) as rn
        from bronze_trades) as r where rn = 1),
    states as (
      select *, row(security_id, trader_id, trade_type, quantity, price) as state,
             lag(row(security_id, trader_id, trade_type, quantity, price))
               over (partition by trade_id order by modified) as old_state,
             lag(modified) over (partition by trade_id order by modified) as was
      from days)
    select trade_id, trader_id, cast(quantity as double) as quantity,
           cast(modified as varchar) as valid_from,
           cast(coalesce(lead(modified) over (partition by trade_id order by modified) - 1,
                         date '9999-12-31') as varchar) as valid_to
    from states where was is null or state is distinct from old_state""".replace(
        "with days as", "select * from (with days as", 1
    )
    + ") as versions",
)
def _(b: Blotter):
    dated = b.bronze().withColumn("modified", F.col("last_modified_ts").cast("date"))
    daily = conform.latest_per_key(
        dated, ["trade_id", "modified"], ["last_modified_ts"], conform.BLOTTER_TIES
    )
    compare = ["security_id", "trader_id", "trade_type", "quantity", "price"]
    versions = history.scd2_from_snapshots(daily, "trade_id", compare, "modified")
    return versions.select("trade_id", "trader_id", "quantity", "valid_from", "valid_to")


AS_OF_JOIN = """select s.trade_id, cast(s.trade_value as double) as trade_value,
    coalesce(h.desk, 'none') as desk, coalesce(h.region, 'none') as region
    from silver_trades as s left join trader_history as h
      on s.trader_id = h.trader_id and s.trade_date between h.valid_from and h.valid_to"""


def _as_of(b: Blotter, limit: int) -> DataFrame:
    out = joins.join_as_of(b.silver(), trader_history(b), "trader_id", "trade_date", limit=limit)
    return out.select("trade_id", "trade_value", "desk", "region")


@query("join_as_of", "silver_trades", "trader_history", sql=AS_OF_JOIN)
def _(b: Blotter):
    return _as_of(b, joins.BROADCAST_LIMIT)


@query("join_as_of_large_history", "silver_trades", "trader_history", sql=AS_OF_JOIN)
def _(b: Blotter):
    return _as_of(b, 0)


@query(
    "events_as_of_user_state",
    "user_history",
    sql="""select h.state, e.event_type, count(*) as n,
                  cast(sum(cast(e.value as decimal(18,2))) as double) as total_value
           from events as e join user_history as h on e.user_id = h.user_id
             and cast(e.ts as date) between h.valid_from and h.valid_to
           group by h.state, e.event_type""",
)
def _(b: Blotter):
    states = history.scd2_from_snapshots(b.user_days(), "user_id", ["state"], "day")
    events = b.table("events").select(
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.col("ts").cast("date").alias("day"),
    )
    joined = joins.join_as_of(events, states, "user_id", "day", "inner", limit=0)
    return gold.totals(joined, ["state", "event_type"], "value", "total_value", "n")


@query(
    "value_by_current_desk",
    "silver_trades",
    "trader_history",
    sql="""select coalesce(desk, 'none') as desk, cast(sum(trade_value) as double)
                      as total_trade_value, count(*) as trade_count
           from silver_trades left join (select * from trader_history where is_current) as h
             using (trader_id) group by desk""",
)
def _(b: Blotter):
    joined = joins.join_current(b.silver(), trader_history(b), "trader_id")
    return gold.totals(joined, ["desk"])


def _stored_history(b: Blotter) -> DataFrame:
    """Batches written one by one, each replacing two folders of the stored table."""
    path = work_folder(b.spark, "history")
    sinks.write_history(history.scd2_init(b.first_traders(), LOAD_DATE), path)
    for date, snapshot in b.trader_batches():
        stored = b.spark.read.parquet(path)
        after = history.scd2_apply(stored, snapshot, "trader_id", TRADER_STATE, date)
        sinks.write_history(sinks.changed_versions(after, date), path)
    return b.spark.read.parquet(path)


@query("stored_history", "trader_history", sql=f"select {HISTORY_COLUMNS} from trader_history")
def _(b: Blotter):
    return _stored_history(b).select(
        "trader_id", "trader_name", "desk", "region", "valid_from", "valid_to", "is_current"
    )


@query("republished_history", "trader_history", sql=f"select {HISTORY_COLUMNS} from trader_history")
def _(b: Blotter):
    """Each batch replaces the table it reads."""
    folder = work_folder(b.spark, "scd2")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")

    def first():
        return history.scd2_init(b.first_traders(), LOAD_DATE)

    for date, snapshot in b.trader_batches():
        table = catalog.read_or_init(b.spark, name, first)
        after = history.scd2_apply(table, snapshot, "trader_id", TRADER_STATE, date)
        sinks.publish(b.spark, after, name, folder)
    return catalog.read_table(b.spark, name)


@query(
    "lakehouse_build",
    "bronze_trades",
    "silver_trades",
    "gold_daily",
    "dim_trader",
    "trader_states",
    sql=f"""select 'silver' as layer, count(*) as n from silver_trades
            union all select 'gold', count(*) from gold_daily
            union all select 'dim', count(*) from dim_trader
            union all select 'history', count(*) + (
                select count(*) from trader_states as s join dim_trader as d using (trader_id)
                where snapshot_date = date '{SECOND_BATCH}'
                  and (s.desk is distinct from d.desk or s.region is distinct from d.region))
              from dim_trader
            union all select 'failed check: bronze_trades_positive_quantity_and_price', count(*)
              from bronze_trades where quantity <= 0 or price <= 0""",
)
def _(b: Blotter):
    """Two runs over the same trades, the second with moved traders."""
    lake, moved = work_folder(b.spark, "build"), b.trader_batches()[1][1]
    for date, dim in ((LOAD_DATE, b.traders()), (SECOND_BATCH, moved)):
        done = medallion.build(b.spark, b.bronze(), dim, lake, date)
    layers = {"silver": done.silver, "gold": done.gold, "dim": done.traders}
    counts = [
        df.agg(F.lit(name).alias("layer"), F.count("*").alias("n"))
        for name, df in {**layers, "history": done.history}.items()
    ]
    failed = [
        (f"failed check: {c.check_name}", c.failing_rows) for c in done.checks if not c.passed
    ]
    schema = "layer string, n bigint"
    return history.assemble(*counts, b.spark.createDataFrame(failed, schema))


# --- upsert and windows ---------------------------------------------------------------

LOADED_AT = "2002-02-01 00:00:00"


@query(
    "upsert_silver",
    "first_book",
    "silver_trades",
    sql="""select coalesce(b.trade_id, s.trade_id) as trade_id,
                  coalesce(b.trader_id, s.trader_id) as trader_id,
                  cast(coalesce(s.quantity, b.quantity) as double) as quantity,
                  cast(coalesce(s.price, b.price) as double) as price,
                  cast(coalesce(s.trade_value, b.trade_value) as double) as trade_value
           from first_book as b full join silver_trades as s on b.trade_id = s.trade_id""",
)
def _(b: Blotter):
    merged = upsert.upsert(
        b.first_book(), b.silver(), ["trade_id"], ["quantity", "price", "trade_value"]
    )
    return merged.select("trade_id", "trader_id", "quantity", "price", "trade_value")


BACKFILL = f"""select {SILVER_COLUMNS}, cast(trade_value as double) as trade_value,
    '{LOADED_AT}' as silver_loaded_ts from silver_trades"""


@query("window_backfill", "silver_trades", sql=BACKFILL)
def _(b: Blotter):
    return windows.backfill(b.bronze(), LOADED_AT)


@query(
    "window_extract",
    "bronze_trades",
    sql=f"""select {SILVER_COLUMNS} from bronze_trades
            where trade_date = cast(timestamp '{RUN_TS}' as date) - 1""",
)
def _(b: Blotter):
    b.bronze().createOrReplaceTempView("trade_blotter")
    window = b.spark.range(1).select(columns.previous_window(RUN_TS)).first()[0]
    return b.spark.sql(
        """SELECT trade_id, trade_date, security_id, trader_id, trade_type, quantity, price
           FROM trade_blotter WHERE trade_date = CAST(:window_date AS DATE)""",
        args={"window_date": window},
    )


@query(
    "window_summary",
    "bronze_trades",
    "silver_trades",
    sql="""select cast(d as varchar) as window_date,
                  (select count(*) from bronze_trades where trade_date = d) as bronze_row_count,
                  (select count(*) from silver_trades where trade_date = d) as silver_row_count
           from (values (date '1998-01-04'), (date '1998-01-05')) as w(d)""",
)
def _(b: Blotter):
    lake = work_folder(b.spark, "lake")
    done = windows.run_windows(b.spark, b.bronze(), lake, ["1998-01-05", "1998-01-04"], LOADED_AT)
    schema = "window_date string, bronze_row_count bigint, silver_row_count bigint"
    return b.spark.createDataFrame(
        [(d["window_date"], d["bronze_row_count"], d["silver_row_count"]) for d in done], schema
    )


@query(
    "window_month",
    "bronze_trades",
    "silver_trades",
    sql="""select cast(d as varchar) as window_date,
                  coalesce(bn, 0) as bronze_row_count, coalesce(sn, 0) as silver_row_count
           from (select distinct cast(o_orderdate as date) as d from orders) as days
           left join (select trade_date as d, count(*) as bn from bronze_trades group by 1) using (d)
           left join (select trade_date as d, count(*) as sn from silver_trades group by 1) using (d)""",
)
def _(b: Blotter):
    """All windows in one load, one per day of the calendar that has orders."""
    ordered = b.table("orders").select(F.col("o_orderdate").cast("date")).distinct()
    days = [r[0] for r in ordered.collect()]
    return windows.load_windows(
        b.spark, b.bronze(), work_folder(b.spark, "month"), days, LOADED_AT
    )


@query(
    "upsert_stored",
    "first_book",
    "silver_trades",
    sql="""select coalesce(b.trade_id, s.trade_id) as trade_id,
                  coalesce(strftime(b.trade_date, '%Y-%m'), case when s.trade_id % 7 <> 0
                           then strftime(s.trade_date, '%Y-%m') end, 'none') as month,
                  coalesce(b.trader_id, s.trader_id) as trader_id,
                  cast(coalesce(s.quantity, b.quantity) as double) as quantity,
                  cast(coalesce(s.price, b.price) as double) as price
           from first_book as b full join silver_trades as s on b.trade_id = s.trade_id""",
)
def _(b: Blotter):
    """Two upserts into a table stored by month; some of the new trades have none."""
    names = ["trade_id", "trader_id", "quantity", "price"]
    path = f"{work_folder(b.spark, 'upserts')}/trades"
    month = F.date_format("trade_date", "yyyy-MM")
    first = b.first_book().select(*names, month.alias("month"))
    later = b.silver().select(*names, F.when(F.col("trade_id") % 7 != 0, month).alias("month"))
    for source in (first, later):
        upsert.upsert_partitions(
            b.spark, path, source, ["trade_id"], ["quantity", "price"], "month"
        )
    return files.read_or_create(b.spark, path, first.schema, "month")


@query(
    "window_read_back",
    "silver_trades",
    sql=f"""select {SILVER_COLUMNS} from silver_trades
            where trade_date = (select cast(max(o_orderdate) as date) from orders)""",
)
def _(b: Blotter):
    """The last day, stored as a window of its own and read from its folder."""
    last = b.table("orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    root = work_folder(b.spark, "window")
    sinks.write_window(day_of_silver(b, last), root, last)
    return files.read_window(b.spark, root, last).drop("window_date")


def day_of_silver(b: Blotter, day) -> DataFrame:
    names = [c for c in schemas.TRADES.names if c != "last_modified_ts"]
    return files.extract_window(b.silver(), day, names, "trade_date")


@query(
    "window_folders",
    "silver_trades",
    sql="""select cast(trade_date as varchar) as window_date, count(*) as n,
                  cast(sum(trade_value) as double) as total_trade_value
           from silver_trades group by trade_date""",
)
def _(b: Blotter):
    root = work_folder(b.spark, "windows")
    monthly = b.silver().withColumn("month", F.date_format("trade_date", "yyyy-MM"))
    sinks.write_partitioned(monthly, root, "month")
    stored = files.read_parquet(b.spark, root)
    return stored.groupBy(F.col("trade_date").alias("window_date")).agg(
        F.count("*").alias("n"), gold.total_of("trade_value").alias("total_trade_value")
    )


# --- open-ended snapshots -------------------------------------------------------------

SNAPSHOT_SQL = """
    select trader_id, coalesce(desk, 'none') as desk, region, dbt_valid_from,
           coalesce(dbt_valid_to, 'none') as dbt_valid_to,
           md5(trader_id || '|' || dbt_valid_from || '.000000') as dbt_scd_id
    from (select trader_id, desk, region,
                 strftime(valid_from, '%Y-%m-%d 00:00:00') as dbt_valid_from,
                 case when not is_current
                      then strftime(valid_to + 1, '%Y-%m-%d 00:00:00') end as dbt_valid_to
          from trader_history) as h"""


def _cut(b: Blotter, table: DataFrame) -> DataFrame:
    """Store a table between batches; a batch reads it twice, so plans would double."""
    path = work_folder(b.spark, "step")
    sinks.write_parquet(table, path)
    return files.read_parquet(b.spark, path)


def _snapshot_shown(df: DataFrame) -> DataFrame:
    return df.select(
        "trader_id",
        "desk",
        "region",
        "dbt_valid_from",
        "dbt_valid_to",
        "dbt_scd_id",
    )


@query("snapshot_check", "trader_history", sql=SNAPSHOT_SQL)
def _(b: Blotter):
    table = history.snapshot_init(b.first_traders(), "trader_id", f"{LOAD_DATE} 00:00:00")
    for date, source in b.trader_batches():
        table = history.snapshot_check(
            table, source, "trader_id", [*TRADER_STATE, "trader_name"], f"{date} 00:00:00"
        )
        table = _cut(b, table)
    return _snapshot_shown(table)


@query(
    "snapshot_timestamp",
    "bronze_trades",
    sql="""with firsts as (select trade_id, min(last_modified_ts) as a, max(last_modified_ts) as z
                           from bronze_trades group by trade_id)
           select trade_id, cast(a as varchar) as dbt_valid_from,
                  case when z > a then cast(z as varchar) else 'none' end as dbt_valid_to
           from firsts
           union all
           select trade_id, cast(z as varchar), 'none' from firsts where z > a""".replace(
        "with firsts as", "select * from (with firsts as", 1
    )
    + ") as versions",
)
def _(b: Blotter):
    def version(pick):
        row = F.struct("last_modified_ts", *conform.BLOTTER_TIES)
        one = b.bronze().groupBy("trade_id").agg(pick(row).alias("row"))
        return one.select("trade_id", "row.last_modified_ts", "row.quantity", "row.price")

    first = history.snapshot_init(version(F.min), "trade_id", F.col("last_modified_ts"))
    table = history.snapshot_timestamp(first, version(F.max), "trade_id", "last_modified_ts")
    return table.select(
        "trade_id",
        "dbt_valid_from",
        "dbt_valid_to",
    )


@query(
    "snapshot_as_of",
    "trader_history",
    sql="""select trader_id, coalesce(desk, 'none') as desk, region from trader_history
           where date '1998-01-01' between valid_from and valid_to""",
)
def _(b: Blotter):
    table = history.snapshot_init(b.first_traders(), "trader_id", f"{LOAD_DATE} 00:00:00")
    for date, source in b.trader_batches():
        table = history.snapshot_check(
            table, source, "trader_id", TRADER_STATE, f"{date} 00:00:00"
        )
        table = _cut(b, table)
    at = history.snapshot_as_of(table, "1998-01-01 00:00:00")
    return at.select("trader_id", "desk", "region")


# --- row security and measures --------------------------------------------------------

LOGIN, ADMIN = "user7@example.com", "compliance_admin"
SIDES = """select trade_type, cast(sum(trade_value) as double) as total_trade_value,
    count(*) as trade_count from silver_trades {where} group by trade_type"""


@query(
    "rls_totals",
    "silver_trades",
    "logins",
    sql=SIDES.format(
        where=f"where trader_id in (select trader_id from logins where login_name = '{LOGIN}')"
    ),
)
def _(b: Blotter):
    seen = security.row_filter(b.silver(), b.logins(), LOGIN, {ADMIN})
    return gold.totals(seen, ["trade_type"])


@query("rls_admin", "silver_trades", sql=SIDES.format(where=""))
def _(b: Blotter):
    seen = security.row_filter(b.silver(), b.logins(), ADMIN, {ADMIN})
    return gold.totals(seen, ["trade_type"])


@query(
    "rls_dim",
    "dim_trader",
    "logins",
    sql=f"""select trader_id, trader_name, desk, region from dim_trader
            where trader_id in (select trader_id from logins where login_name = '{LOGIN}')""",
)
def _(b: Blotter):
    return security.row_filter(b.traders(), b.logins(), LOGIN, {ADMIN})


@query(
    "rls_via_dim",
    "gold_daily",
    "logins",
    sql=f"""select {DAILY} from gold_daily
            where trader_id in (select trader_id from logins where login_name = '{LOGIN}')""",
)
def _(b: Blotter):
    return security.row_filter_via_dim(b.gold(), b.traders(), b.logins(), LOGIN, {ADMIN})


@query(
    "rls_group",
    "silver_trades",
    "dim_trader",
    sql=SIDES.format(
        where="where trader_id in (select trader_id from dim_trader where region = 'ASIA')"
    ),
)
def _(b: Blotter):
    seen = security.group_filter(b.silver(), b.traders(), F.col("region") == "ASIA")
    return gold.totals(seen, ["trade_type"])


@query(
    "rls_function",
    "silver_trades",
    "logins",
    sql=SIDES.format(
        where=f"where trader_id in (select trader_id from logins where login_name = '{LOGIN}')"
    ),
)
def _(b: Blotter):
    b.silver().createOrReplaceTempView("secured_trades")
    b.logins().createOrReplaceTempView("trader_login_mapping")
    security.create_visibility_function(b.spark, "trader_visible", "trader_login_mapping")
    return b.spark.sql(
        """SELECT trade_type, CAST(sum(trade_value) AS DECIMAL(28,2)) AS total_trade_value,
                  count(*) AS trade_count
           FROM secured_trades t, LATERAL trader_visible(t.trader_id, :login)
           GROUP BY trade_type""",
        args={"login": LOGIN},
    )


@query(
    "rls_view",
    "silver_trades",
    "dim_trader",
    sql="""select desk, trade_type, cast(sum(trade_value) as double) as total_trade_value,
                  count(*) as trade_count
           from silver_trades join dim_trader using (trader_id)
           where region = 'EUROPE' group by desk, trade_type""",
)
def _(b: Blotter):
    """The session's own user is mapped to one region's traders; fact and dim are bound."""
    mine = b.traders().where("region = 'EUROPE'").select(
        "trader_id", F.session_user().alias("login_name")
    )
    mine.createOrReplaceTempView("my_logins")
    for name, table in (("silver_trades", b.silver()), ("gold_dim_trader", b.traders())):
        table.createOrReplaceTempView(name)
        security.create_secured_view(b.spark, f"secured_{name}", name, "my_logins", ADMIN)
    fact = catalog.read_table(b.spark, "secured_silver_trades")
    dim = catalog.read_table(b.spark, "secured_gold_dim_trader")
    return gold.totals(joins.star_join(fact, {"trader_id": dim}), ["desk", "trade_type"])


@query("rls_live", "silver_trades", sql=SIDES.format(where="where trader_id = 3"))
def _(b: Blotter):
    return security.live_totals(b.silver(), security.own_rows(3))


@query("frozen_extract", "silver_trades", sql=SIDES.format(where=""))
def _(b: Blotter):
    stored = work_folder(b.spark, "extract")
    return security.frozen_extract(b.silver(), security.own_rows(None), stored, b.spark)


@query(
    "visibility_report",
    "silver_trades",
    "logins",
    sql="""select login_name, count(*) as visible_rows,
                  cast(sum(trade_value) as double) as visible_value
           from silver_trades join logins using (trader_id) group by login_name
           union all
           select 'compliance_admin', count(*), cast(sum(trade_value) as double)
           from silver_trades""",
)
def _(b: Blotter):
    return security.visibility_report(b.silver(), b.logins(), "trader_id", "trade_value", ADMIN)


@query(
    "trader_login_lookup",
    "dim_trader",
    "logins",
    sql="""select trader_id, desk, login_name as login
           from dim_trader left join logins using (trader_id)""",
)
def _(b: Blotter):
    found = joins.lookup(b.traders(), b.logins(), "trader_id", "login_name", "login")
    return found.select("trader_id", "desk", "login")


@query(
    "measure_by_desk",
    "gold_daily",
    "dim_trader",
    sql="""select desk, cast(sum(total_trade_value) as double) as "Total Trade Value",
                  cast(sum(trade_count) as bigint) as "Trade Count"
           from gold_daily join dim_trader using (trader_id) group by desk""",
)
def _(b: Blotter):
    model = joins.relate(b.gold(), b.traders(), "trader_id")
    return measures.measure(model, ["Total Trade Value", "Trade Count"], by=["desk"])


@query(
    "measure_current_region",
    "gold_daily",
    "trader_history",
    sql="""select region, cast(sum(total_trade_value) as double) as "Total Trade Value"
           from gold_daily join (select * from trader_history where is_current) as h
             using (trader_id)
           where region <> 'GLOBAL' group by region""",
)
def _(b: Blotter):
    return measures.measure_current(
        b.gold(),
        trader_history(b),
        "trader_id",
        "Total Trade Value",
        by=["region"],
        where=F.col("region") != "GLOBAL",
    )


# --- files, tables and arrivals -------------------------------------------------------

ORDERS_AS_READ = """select o_orderstatus, count(*) as n,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_price,
    cast(min(cast(o_orderdate as date)) as varchar) as first_day
    from orders group by o_orderstatus"""


ORDERS_ROWS = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    cast(cast(o_orderdate as date) as varchar) as o_orderdate, o_orderpriority from orders"""


def _order_rows(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_price"),
        F.min(F.col("o_orderdate").cast("date")).alias("first_day"),
    )


@query("roundtrip_csv", sql=ORDERS_AS_READ)
def _(b: Blotter):
    path, orders = work_folder(b.spark, "csv"), b.table("orders")
    sinks.write_csv(orders, path)
    return _orders_by_status(files.read_csv(b.spark, path, orders.schema))


@query(
    "roundtrip_csv_rows",
    sql="""select doc_id, coalesce(text, 'none') as text, coalesce(lang, 'none') as lang,
                  coalesce(source, 'none') as source, n_chars from documents""",
)
def _(b: Blotter):
    """Every cell of every row, line breaks and quotes in the texts included."""
    path, docs = work_folder(b.spark, "csv"), b.table("documents")
    sinks.write_csv(docs, path)
    return files.read_csv(b.spark, path, docs.schema)


@query("roundtrip_csv_inferred", sql=ORDERS_AS_READ)
def _(b: Blotter):
    path = work_folder(b.spark, "csv")
    sinks.write_csv(b.table("orders"), path)
    return _orders_by_status(files.read_csv(b.spark, path))


@query("roundtrip_parquet", sql=ORDERS_AS_READ)
def _(b: Blotter):
    path = work_folder(b.spark, "parquet")
    sinks.land(b.table("orders"), b.folder, path)
    return _orders_by_status(files.read_parquet(b.spark, path))


@query("roundtrip_clustered", sql=ORDERS_ROWS)
def _(b: Blotter):
    path = work_folder(b.spark, "clustered")
    sinks.write_clustered(b.table("orders"), path, 8, "o_custkey")
    return _order_rows(files.read_parquet(b.spark, path))


@query(
    "roundtrip_load_date",
    sql="""select '2024-02-01' as "LoadDate", event_type, count(*) as n
           from (select distinct * from events) as d group by event_type""",
)
def _(b: Blotter):
    path = work_folder(b.spark, "loads")
    sinks.write_load_date(conform.distinct_rows(b.table("events")), path, "2024-02-01")
    stored = files.read_parquet(b.spark, path)
    return stored.groupBy("LoadDate", "event_type").agg(F.count("*").alias("n"))


@query("seed_table", sql=ORDERS_ROWS)
def _(b: Blotter):
    folder, orders = work_folder(b.spark, "seed"), b.table("orders")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    sinks.write_csv(orders, f"{folder}/orders.csv")
    seed = catalog.load_seed(
        b.spark, f"{folder}/orders.csv", name, orders.schema, f"{folder}/table"
    )
    return _order_rows(seed)


@query("bulk_loaded_table", sql=ORDERS_ROWS)
def _(b: Blotter):
    folder, orders = work_folder(b.spark, "bulk"), b.table("orders")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    sinks.write_csv(orders, f"{folder}/orders.csv")
    sinks.publish(b.spark, orders.where("false"), name, f"{folder}/table")
    return _order_rows(catalog.bulk_load(b.spark, f"{folder}/orders.csv", name))


@query(
    "published_gold",
    "gold_daily",
    sql="""select trade_type, count(*) as n, cast(sum(total_trade_value) as double) as total
           from gold_daily group by trade_type""",
)
def _(b: Blotter):
    folder = work_folder(b.spark, "gold")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    stored = sinks.materialize(b.spark, b.gold(), name, "table", f"{folder}/table")
    return stored.groupBy("trade_type").agg(
        F.count("*").alias("n"), gold.total_of("total_trade_value").alias("total")
    )


@query(
    "stored_failures",
    "bronze_trades",
    sql=f"""select {SILVER_COLUMNS} from bronze_trades where quantity <= 0 or price <= 0""",
)
def _(b: Blotter):
    folder = work_folder(b.spark, "failures")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    bad = (F.col("quantity") <= 0) | (F.col("price") <= 0)
    failing = quality.expression_check(b.bronze(), bad).drop("last_modified_ts")
    return sinks.store_failures(b.spark, failing, name, f"{folder}/table")


@query(
    "landing_files",
    sql="""select o_orderstatus as landed_as, count(*) as n,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_price
           from orders group by o_orderstatus""",
)
def _(b: Blotter):
    folder, orders = work_folder(b.spark, "landing"), b.table("orders")
    landed = orders.withColumn("landed_as", F.col("o_orderstatus"))
    landed.write.partitionBy("landed_as").option("header", True).csv(folder)
    rows = files.read_landing(b.spark, f"{folder}/*", orders.schema)
    return rows.groupBy(F.col("o_orderstatus").alias("landed_as")).agg(
        F.count("_file").alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_price"),
    )


@query(
    "landed_files",
    sql="""select o_orderstatus as landed_as, count(*) as row_count
           from orders group by o_orderstatus""",
)
def _(b: Blotter):
    """Row counts per file of a landing folder, summed per kind of order."""
    folder, orders = work_folder(b.spark, "landing"), b.table("orders")
    landed = orders.withColumn("landed_as", F.col("o_orderstatus"))
    landed.write.partitionBy("landed_as").option("header", True).csv(folder)
    found = files.landed_files(b.spark, f"{folder}/*", orders.schema)
    kind = F.regexp_extract("path", "landed_as=([^/]+)", 1).alias("landed_as")
    return found.groupBy(kind).agg(F.sum("row_count").alias("row_count"))


@query(
    "snapshot_of_date",
    "trader_states",
    sql=f"""select trader_id, trader_name, coalesce(desk, 'none') as desk, region
            from trader_states where snapshot_date = date '{SECOND_BATCH}'""",
)
def _(b: Blotter):
    root = work_folder(b.spark, "snapshots")
    for date, snapshot in b.trader_batches():
        dated = snapshot.withColumn("snapshot_date", F.lit(date).cast("date"))
        sinks.write_csv(dated, files.snapshot_path(root, "dim_trader_snapshot", date))
    return files.read_snapshot(
        b.spark, root, "dim_trader_snapshot", SECOND_BATCH, schemas.TRADER_SNAPSHOT
    )


@query(
    "file_arrival_dedupe",
    sql="""select '2024-02-01' as "LoadDate", event_type, count(*) as n,
                  cast(sum(cast(value as decimal(18,2))) as double) as total_value
           from (select distinct * from events) as d group by event_type""",
)
def _(b: Blotter):
    folder, events = work_folder(b.spark, "arrivals"), b.table("events")
    # the same events arrive twice, in two deliveries
    for delivery in ("monday", "tuesday"):
        sinks.write_csv(events, f"{folder}/in/{delivery}")
        arrivals.ingest_stream(
            b.spark,
            f"{folder}/in",
            f"{folder}/out",
            f"{folder}/checkpoint",
            events.schema,
            load_date="2024-02-01",
            day_column="ts",
        ).awaitTermination()
    stored = arrivals.read_ingested(b.spark, f"{folder}/out")
    return stored.groupBy("LoadDate", "event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")
    )
