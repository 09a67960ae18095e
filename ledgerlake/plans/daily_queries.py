"""Registered queries of incremental loads, checked publication and two-way ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import gold, history, joins, security, sketches, upsert
from ledgerlake.operators.conform import BLOTTER_TIES
from ledgerlake.plans import incremental, medallion, procedure
from ledgerlake.plans.blotter import FIRST_BATCH, LOAD_DATE, SECOND_BATCH, Blotter
from ledgerlake.plans.queries import (
    HISTORY_COLUMNS,
    LOADED_AT,
    TRADER_STATE,
    query,
    trader_history,
)
from ledgerlake.session import work_folder
from ledgerlake.sinks import tables as sinks
from ledgerlake.sources import files, ingest
from ledgerlake.streaming import stateful

SPLIT = "1995-06-17"  # fixed value: versions before it arrive with the first load

_NEWEST = "last_modified_ts desc, " + ", ".join(f"{c} desc" for c in BLOTTER_TIES)


@query(
    "gold_incremental",
    "bronze_trades",
    "silver_trades",
    sql=f""", early as (
      select trade_id, trade_date, trader_id, trade_type,
             cast(round(quantity * price, 2) as decimal(18,2)) as trade_value
      from (select *, row_number() over (partition by trade_id order by {_NEWEST}) as rn
            from bronze_trades where last_modified_ts < timestamp '{SPLIT}') as r
      where rn = 1 and quantity > 0 and price > 0
    ), merged as (
      select coalesce(e.trade_date, s.trade_date) as trade_date,
             coalesce(e.trader_id, s.trader_id) as trader_id,
             coalesce(e.trade_type, s.trade_type) as trade_type,
             coalesce(s.trade_value, e.trade_value) as trade_value
      from early as e full join silver_trades as s on e.trade_id = s.trade_id
    )
    select cast(trade_date as varchar) as trade_date, trader_id, trade_type,
           cast(sum(trade_value) as double) as total_trade_value, count(*) as trade_count
    from merged group by trade_date, trader_id, trade_type""",
)
def _(b: Blotter):
    """Two loads over all days, the second with corrections; Gold takes the differences."""
    lake, bronze = work_folder(b.spark, "incremental"), b.bronze()
    days = [r[0] for r in bronze.select("trade_date").distinct().collect()]  # one per day
    early = bronze.where(F.col("last_modified_ts") < F.lit(SPLIT).cast("timestamp_ntz"))
    for run, source in (("first", early), ("second", bronze)):
        incremental.load_days(b.spark, source, lake, days, LOADED_AT, run, "month")
    return incremental.read_gold(b.spark, f"{lake}/gold/daily")


@query(
    "scd2_fold_refused",
    "trader_states",
    "trader_history",
    sql=f"""
    select s.trader_id, s.trader_name, coalesce(s.desk, 'none') as desk, s.region,
           '{FIRST_BATCH}' as batch_date, 'late' as reason
    from trader_states as s join trader_history as h using (trader_id)
    where s.snapshot_date = date '{FIRST_BATCH}' and h.is_current
      and h.valid_from >= date '{FIRST_BATCH}'
      and (s.desk is distinct from h.desk or s.region is distinct from h.region)
    union all
    select null, trader_name, coalesce(desk, 'none'), region, '2001-01-01', 'no key'
    from trader_states where snapshot_date = date '{SECOND_BATCH}' and region = 'GLOBAL'""",
)
def _(b: Blotter):
    """An old snapshot that comes again, and one whose rows of a region lost their key."""
    first = history.scd2_init(b.first_traders(), LOAD_DATE)
    (early, old), (late, new) = b.trader_batches()
    table = history.scd2_fold(first, [(early, old), (late, new)], "trader_id", TRADER_STATE)
    known = F.when(F.col("region") != "GLOBAL", F.col("trader_id"))
    batches = [(early, old), ("2001-01-01", new.withColumn("trader_id", known))]
    return history.scd2_fold_refused(table, batches, "trader_id", TRADER_STATE)


@query(
    "history_from_files",
    "trader_history",
    sql=f"select {HISTORY_COLUMNS} from trader_history",
)
def _(b: Blotter):
    """A series of dated snapshot files, read in one scan and chained into a history."""
    root = work_folder(b.spark, "series")
    for day, snapshot in [(LOAD_DATE, b.first_traders()), *b.trader_batches()]:
        dated = snapshot.withColumn("snapshot_date", F.lit(day).cast("date"))
        sinks.write_csv(dated, files.snapshot_path(root, "dim_trader_snapshot", day))
    good, _ = ingest.read_snapshots(
        b.spark, root, "dim_trader_snapshot", schemas.TRADER_SNAPSHOT, ["trader_id"]
    )
    return history.scd2_from_snapshots(good, "trader_id", TRADER_STATE, "snapshot_date")


def deliver(events: DataFrame, folder: str) -> None:
    """Events as CSV files that somebody spoilt: text where a number belongs, short lines."""
    cells = {c: F.col(c).cast("string").alias(c) for c in events.columns}
    spoilt = {**cells, "value": F.lit("n/a").alias("value")}
    number = F.col("event_id")
    line = (
        F.when(number % 11 == 0, F.to_csv(F.struct(*spoilt.values()), {"escape": '"'}))
        .when(number % 13 == 0, F.to_csv(F.struct(*list(cells.values())[:2])))
        .otherwise(F.to_csv(F.struct(*cells.values()), {"escape": '"'}))
    )
    # a single column named like the header, written as it is
    lines = events.select(line.alias(",".join(events.columns))).write.mode("overwrite")
    lines.options(header=True, sep="\x01", escapeQuotes=False).csv(folder)


@query(
    "ingest_rejects",
    sql="""
    select case when event_id % 11 = 0 then 'value is not of type double'
                when event_id % 13 = 0 then 'wrong number of cells'
                else 'good' end as reason,
           count(*) as n, count(case when event_id % 11 <> 0 and event_id % 13 <> 0
                                     then value end) as n_values
    from events group by 1""",
)
def _(b: Blotter):
    """Every event delivered is a good row or a reject with its reason."""
    folder, events = work_folder(b.spark, "two_ways"), b.table("events")
    deliver(events, folder)
    good, rejects = ingest.read_landing_two_ways(b.spark, folder, events.schema)
    good = good.select(F.lit("good").alias("reason"), "value")
    told = good.unionByName(rejects.select("reason"), allowMissingColumns=True)
    return told.groupBy("reason").agg(F.count("*").alias("n"), F.count("value").alias("n_values"))


@query(
    "arrivals_with_state",
    sql="""
    with good as (
      select *, event_id % 10 = 0 as second from events
      where event_id % 11 <> 0 and event_id % 13 <> 0
    ), mark as (
      select make_timestamp(epoch_ms(max(ts)) * 1000) - interval 2 days as since
      from good where not second
    ), told as (
      select case when second and ts <= since then 'late' else 'row' end as reason
      from good, mark
      union all
      select case when event_id % 11 = 0 then 'value is not of type double'
                  else 'wrong number of cells' end
      from events where event_id % 11 = 0 or event_id % 13 = 0
      union all
      select case when event_id % 11 = 0 then 'value is not of type double'
                  else 'wrong number of cells' end
      from events where (event_id % 11 = 0 or event_id % 13 = 0) and event_id % 10 <> 0
    )
    select reason, count(*) as n from told group by reason""",
)
def _(b: Blotter):
    """Nine of ten events arrive, then all of them: copies go, late ones are set aside."""
    folder, events = work_folder(b.spark, "stateful"), b.table("events")
    for delivery, part in (
        ("monday", events.where("event_id % 10 <> 0")),
        ("tuesday", events),
    ):
        deliver(part, f"{folder}/in/{delivery}")
        stateful.ingest_once(
            b.spark,
            f"{folder}/in",
            f"{folder}/out",
            f"{folder}/checkpoint",
            events.schema,
            "ts",
        ).awaitTermination()
    rows = stateful.read_rows(b.spark, f"{folder}/out", events.schema)
    told = rows.select(F.lit("row").alias("reason")).union(
        stateful.read_rejects(b.spark, f"{folder}/out").select("reason")
    )
    return told.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "as_of_user_state_of_day",
    "silver_trades",
    "user_history",
    sql="""select s.trade_id, coalesce(h.state, 'none') as state
           from silver_trades as s left join user_history as h
             on s.trader_id = h.user_id
            and s.trade_date + 10000 between h.valid_from and h.valid_to""",
)
def _(b: Blotter):
    """Long histories, most days of which lie before or after their facts."""
    states = history.scd2_from_snapshots(b.user_days(), "user_id", ["state"], "day")
    trades = b.silver().select(
        "trade_id", "trader_id", F.date_add("trade_date", 10000).alias("day")
    )
    states = states.withColumnRenamed("user_id", "trader_id")
    joined = joins.join_as_of(trades, states, "trader_id", "day", limit=0, days=7)
    return joined.select("trade_id", "state")


@query(
    "upsert_few_keys",
    "silver_trades",
    sql="""select trade_id, trader_id,
                  cast(case when trade_id % 1009 = 0 then quantity + 1 else quantity end as double)
                      as quantity
           from silver_trades""",
)
def _(b: Blotter):
    """A small batch finds its row groups by key, in a table stored by month."""
    path = f"{work_folder(b.spark, 'keyed')}/trades"
    silver = b.silver().select(
        "trade_id", "trader_id", "quantity", F.date_format("trade_date", "yyyy-MM").alias("month")
    )
    args = (["trade_id"], ["quantity"], "month")
    upsert.upsert_partitions(b.spark, path, silver, *args)
    stored = files.read_or_create(b.spark, path, silver.schema, "month")
    batch = stored.where("trade_id % 1009 = 0").withColumn(
        "quantity", (F.col("quantity") + 1).cast("decimal(18,2)")
    )
    upsert.upsert_partitions(b.spark, path, stored_apart(b, batch), *args)
    return files.read_or_create(b.spark, path, silver.schema, "month").drop("month")


def stored_apart(b: Blotter, df: DataFrame) -> DataFrame:
    """A batch that reads the table it changes is stored before."""
    path = work_folder(b.spark, "batch")
    sinks.write_parquet(df, path)
    return b.spark.read.schema(df.schema).parquet(path)


@query(
    "checked_while_written",
    "bronze_trades",
    "silver_trades",
    "gold_daily",
    "dim_trader",
    sql="""
    select 'bronze_trades_positive_quantity_and_price' as check_name, 'warn' as severity,
           count(*) as failing_rows, count(*) = 0 as passed
    from bronze_trades where quantity <= 0 or price <= 0
    union all
    select name, 'error', 0, true from (values
      ('unique_dim_trader_trader_id'), ('not_null_dim_trader_trader_id'),
      ('unique_silver_trades_trade_id'), ('not_null_silver_trades_trade_id'),
      ('accepted_values_silver_trades_trade_type'), ('positive_value_silver_trades_quantity'),
      ('positive_value_silver_trades_price'),
      ('relationships_gold_fact_trades_daily_trader_id'),
      ('unique_gold_dim_trader_trader_id'), ('not_null_gold_dim_trader_trader_id')) as t(name)
    union all
    select 'gold groups', 'view', count(*), true from gold_daily""",
)
def _(b: Blotter):
    """Layers counted by their own writes, then shown by views that moved in one step."""
    lake = work_folder(b.spark, "watched")
    prefix = lake.rsplit("/", 1)[-1].replace("-", "_")
    done = medallion.build(b.spark, b.bronze(), b.traders(), lake, LOAD_DATE, prefix)
    rows = [(c.check_name, c.severity, c.failing_rows, c.passed) for c in done.checks]
    shown_now = b.spark.table(f"{prefix}_gold_fact_trades_daily").count()
    rows.append(("gold groups", "view", shown_now, True))
    return b.spark.createDataFrame(
        rows, "check_name string, severity string, failing_rows long, passed boolean"
    )


@query(
    "bucketed_join",
    "silver_trades",
    "trader_history",
    sql="""select coalesce(h.desk, 'none') as desk, count(*) as n,
                  cast(sum(s.trade_value) as double) as total_trade_value
           from silver_trades as s join trader_history as h using (trader_id)
           where h.is_current group by 1""",
)
def _(b: Blotter):
    """Silver and the history of its traders in equal buckets, joined where they lie."""
    folder = work_folder(b.spark, "bucketed")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    fact = sinks.write_bucketed(b.silver(), f"{name}_silver", 8, "trader_id", path=f"{folder}/f")
    dims = sinks.write_bucketed(
        trader_history(b), f"{name}_history", 8, "trader_id", path=f"{folder}/d"
    )
    joined = fact.join(history.current(dims).select("trader_id", "desk").hint("merge"), "trader_id")
    return gold.totals(joined, ["desk"], n="n")


@query(
    "profile_from_sketches",
    sql="""
    select * from (values ('l_orderkey'), ('l_partkey'), ('l_quantity'), ('l_returnflag')) as c(column_name),
           (select count(*) as row_count, 0 as null_count, true as distinct_close,
                   true as median_close from lineitem) as t""",
)
def _(b: Blotter):
    """Sketches of every month, stored, merged, and held against exact figures."""
    wanted = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    lines = b.table("lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    lines = lines.select("month", *wanted)
    parts = stored_apart(b, sketches.part_profile(lines, ["month"], lines.columns[1:]))
    found = sketches.merged_profile(parts)
    exact = {}
    for c in wanted:
        counts = stored_apart(b, sketches.ranged_counts(lines, c))
        exact[c] = sketches.counted_figures(counts, () if c == "l_returnflag" else (0.45, 0.55))
    held = F.array(
        *(
            F.struct(
                F.lit(c).alias("of"),
                F.lit(n).cast("bigint").alias("n"),
                F.lit(ends[0] if ends else None).cast("double").alias("low"),
                F.lit(ends[1] if ends else None).cast("double").alias("high"),
            )
            for c, (n, ends) in exact.items()
        )
    )
    mine = F.filter(held, lambda e: e["of"] == F.col("column_name"))[0]
    median = F.col("quantiles")[2]
    return found.select(
        "column_name",
        "row_count",
        "null_count",
        (F.abs(F.col("distinct_estimate") - mine["n"]) <= 0.08 * mine["n"]).alias("distinct_close"),
        F.coalesce(median.between(mine["low"], mine["high"]), F.lit(True)).alias("median_close"),
    )


@query(
    "rls_stored_view",
    "silver_trades",
    sql="""select trade_type, count(*) as trade_count,
                  cast(sum(trade_value) as double) as total_trade_value
           from silver_trades where trader_id % 5 = 0 group by trade_type""",
)
def _(b: Blotter):
    """What another session sees through a view of the catalog."""
    folder = work_folder(b.spark, "secured")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    own = b.logins().withColumn(
        "login_name", F.when(F.col("trader_id") % 5 == 0, F.session_user()).otherwise("someone")
    )
    sinks.publish_version(b.spark, b.silver(), f"{name}_fact", f"{folder}/fact")
    sinks.publish_version(b.spark, own, f"{name}_map", f"{folder}/map")
    security.create_stored_secured_view(b.spark, f"{name}_mine", f"{name}_fact", f"{name}_map")
    seen = b.spark.newSession().table(f"{name}_mine")
    path = f"{folder}/seen"
    sinks.write_parquet(gold.totals(seen, ["trade_type"]), path)
    return files.read_parquet(b.spark, path)


@query(
    "window_procedure",
    "bronze_trades",
    "silver_trades",
    sql="""select cast(d as varchar) as window_date,
                  (select count(*) from bronze_trades where trade_date = d) as bronze_row_count,
                  (select count(*) from silver_trades where trade_date = d) as silver_row_count,
                  (select cast(sum(trade_value) as double) from silver_trades where trade_date = d)
                      as total_trade_value
           from (select distinct cast(o_orderdate as date) as d from orders
                 order by d desc limit 3) as days""",
)
def _(b: Blotter):
    """The last three windows, loaded by the SQL procedure, one of them twice."""
    folder = work_folder(b.spark, "procedure")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    sinks.publish_version(b.spark, b.bronze(), f"{name}_bronze", f"{folder}/bronze")
    procedure.create_silver(b.spark, f"{name}_silver", f"{folder}/silver")
    ordered = b.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    days = [r[0] for r in ordered.orderBy(F.desc("d")).limit(3).collect()]
    told = {}
    for day in [days[0], *days]:
        done = procedure.call_window(
            b.spark, f"{name}_bronze", f"{name}_silver", day, LOADED_AT
        )
        told[day] = tuple(done.first())
    schema = "window_date string, bronze_row_count bigint, silver_row_count bigint"
    summary = b.spark.createDataFrame(list(told.values()), schema)
    silver = b.spark.table(f"{name}_silver").groupBy(
        F.col("trade_date").cast("string").alias("window_date")
    )
    values = silver.agg(gold.total_of("trade_value").alias("total_trade_value"))
    return summary.join(values, "window_date", "left")
