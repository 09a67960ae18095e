"""Guards of keyed loads, incremental Gold, checks while writing, two-way ingest, state."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import JANUARY, SEED, traders, trades
from ledgerlake.operators import history, joins, quality, security, sketches, upsert
from ledgerlake.operators.gold import gold_daily
from ledgerlake.plans import daily_queries, incremental, medallion  # noqa: F401
from ledgerlake.plans.queries import QUERIES
from ledgerlake.schemas import LOGINS, TRADERS
from ledgerlake.session import work_folder
from ledgerlake.sinks import tables as sinks
from ledgerlake.sources import files, ingest
from ledgerlake.streaming import stateful

NOW = "2026-05-10 00:00:00"


# --- keys -----------------------------------------------------------------------------


def test_upsert_refuses_repeated_and_missing_keys(spark, rows, tmp_path):
    target = spark.createDataFrame([(1, 10)], "k int, q int")
    twice = spark.createDataFrame([(2, 1), (2, 2)], target.schema)
    without = spark.createDataFrame([(None, 1)], target.schema)
    for source, said in ((twice, "repeats"), (without, "has no k")):
        with pytest.raises(Exception, match=said):
            upsert.upsert(target, source, ["k"], ["q"]).collect()
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1, 1, "a")], "k int, q int, d string")
    upsert.upsert_partitions(spark, path, good, ["k"], ["q"], "d")
    bad = spark.createDataFrame([(1, 7, "a"), (1, 8, "a")], good.schema)
    with pytest.raises(Exception, match="repeats"):
        upsert.upsert_partitions(spark, path, bad, ["k"], ["q"], "d")
    assert rows(spark.read.parquet(path)) == [(1, 1, "a")]


def test_changes_of_an_upsert_sum_to_the_difference(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, g string, q int")
    source = spark.createDataFrame([(2, "z", 99), (3, "c", 30)], target.schema)
    changes = upsert.upsert_changes(target, source, ["k"], ["q"])
    assert rows(changes) == [(2, "b", 20, -1), (2, "b", 99, 1), (3, "c", 30, 1)]


def test_history_refuses_a_key_twice_on_one_date(spark, rows):
    start = history.scd2_init(
        spark.createDataFrame([(1, "A")], "trader_id int, desk string"), "2020-01-01"
    )
    twice = spark.createDataFrame([(1, "B"), (1, "C")], "trader_id int, desk string")
    with pytest.raises(Exception, match="trader_id repeats on one date"):
        history.scd2_fold(start, [("2021-01-01", twice)], "trader_id", ["desk"]).collect()
    dated = twice.withColumn("d", F.lit("2021-01-01").cast("date"))
    with pytest.raises(Exception, match="trader_id repeats on one date"):
        history.scd2_from_snapshots(dated, "trader_id", ["desk"], "d").collect()
    odd = spark.createDataFrame([(1, "B"), (None, "C")], twice.schema)
    batches = [("2019-01-01", odd), ("2021-01-01", odd.where("trader_id = 1"))]
    refused = history.scd2_fold_refused(start, batches, "trader_id", ["desk"])
    assert rows(refused, "trader_id", "desk", "reason") == [(None, "C", "no key"), (1, "B", "late")]
    folded = history.scd2_fold(start, batches, "trader_id", ["desk"])
    assert rows(folded, "desk", "is_current") == [("A", False), ("B", True)]


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_a_version_without_an_end_is_still_true(spark, rows, limit):
    versions = spark.createDataFrame(
        [(1, "a", "2020-01-01", "2020-12-31"), (1, "b", "2021-01-01", None), (2, "c", "2021-06-01", None)],
        "k int, v string, f string, t string",
    ).select("k", "v", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"))
    fact = spark.createDataFrame(
        [(1, 1, "2020-12-31"), (2, 1, "2031-01-01"), (3, 2, "2021-05-31"), (4, None, "2021-01-01"),
         (5, 1, None), (6, 2, "2021-06-01"), (7, 3, "2021-06-01"), (8, 1, "2019-12-31")],
        "id int, k int, d string",
    ).withColumn("d", F.col("d").cast("date"))
    out = joins.join_as_of(fact, versions, "k", "d", limit=limit, days=7)
    expected = {1: "a", 2: "b", 3: None, 4: None, 5: None, 6: "c", 7: None, 8: None}
    assert dict(rows(out, "id", "v")) == expected
    inner = joins.join_as_of(fact, versions, "k", "d", "inner", limit=limit)
    assert dict(rows(inner, "id", "v")) == {1: "a", 2: "b", 6: "c"}
    assert joins.as_of(versions, "2031-01-01").count() == 2


def test_facts_without_a_key_stay_apart(spark):
    fact = spark.range(8000, numPartitions=8).select(
        "id", F.lit(None).cast("int").alias("k"), F.lit("2020-01-01").cast("date").alias("d")
    )
    versions = spark.createDataFrame([(1, date(2020, 1, 1), None)], "k int, valid_from date, valid_to date")
    out = joins.join_as_of(fact, versions, "k", "d", limit=0)
    counts = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 8000 and max(counts) < 8000


def test_a_small_batch_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "keyed")
    table = spark.range(200_000).select("id", (F.col("id") % 7).alias("q"), F.lit("a").alias("d"))
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        (
            table.repartition(1).sortWithinPartitions("id").write.mode("overwrite")
            .option("parquet.block.size", 64 * 1024)
            .option("parquet.bloom.filter.enabled#id", "true")
            .partitionBy("d").parquet(path)
        )
    finally:
        spark.conf.unset("parquet.block.size")
    stored = spark.read.parquet(path)

    def scanned(df):
        df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()

    batch = spark.createDataFrame([(k,) for k in (5, 77_777, 199_999)], "id long")
    found = upsert.matching_rows(stored, batch, "id")
    assert sorted(r.id for r in found.collect()) == [5, 77_777, 199_999]
    with_names = {"spark.sql.parquet.pushdown.inFilterThreshold": "2000"}
    from ledgerlake.session import with_settings

    with with_settings(spark, with_names):
        few = scanned(upsert.matching_rows(stored, batch, "id"))
    assert few < 200_000 // 2 and scanned(stored.where("q >= 0")) == 200_000
    many = spark.range(100, 100 + upsert.IN_LIST + 500)
    assert upsert.matching_rows(stored, many, "id").count() == upsert.IN_LIST + 500


# --- incremental Gold -----------------------------------------------------------------

LATER = [
    (100001, "2026-05-01", 9, 9, "SELL", "7", "10", "2026-05-02 20:00:00"),
    (100003, "2026-05-01", 3, 2, "BUY", "10", "98.75", "2026-05-02 12:00:00"),
    (100020, "2026-05-04", 3, 2, "BUY", "1", "2", "2026-05-02 12:00:00"),
]


def gold_of(spark, lake):
    silver = spark.read.parquet(f"{lake}/silver_table/trades")
    return gold_daily(silver)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_gold_follows_silver(spark, rows, grain):
    lake = work_folder(spark, "lake")
    days = sorted({r[1] for r in SEED})
    done = incremental.load_days(spark, trades(spark), lake, days[:2], NOW, "r1", grain)
    assert done["gold_folders"] == done["silver_folders"] == (2 if grain == "day" else 1)
    incremental.load_days(spark, trades(spark), lake, days, NOW, "r2", grain)
    incremental.load_days(spark, trades(spark, [*SEED, *LATER]), lake, days, NOW, "r3", grain)
    gold = incremental.read_gold(spark, f"{lake}/gold/daily")
    expected = rows(gold_of(spark, lake))
    assert rows(gold) == expected and len(expected) > 5
    # the same load again, and one that stopped behind Silver
    for run in ("r3", "r3"):
        incremental.load_days(spark, trades(spark, [*SEED, *LATER]), lake, days, NOW, run, grain)
    assert rows(incremental.read_gold(spark, f"{lake}/gold/daily")) == expected


def test_a_load_that_stops_before_gold_is_repeated(spark, rows, monkeypatch):
    lake, days = work_folder(spark, "lake"), sorted({r[1] for r in SEED})
    incremental.load_days(spark, trades(spark), lake, days, NOW, "r1")

    def stop(*_):
        raise RuntimeError("stopped")

    late = trades(spark, [*SEED, *LATER])
    with monkeypatch.context() as patched:
        patched.setattr(incremental, "apply_delta", stop)
        with pytest.raises(RuntimeError):
            incremental.load_days(spark, late, lake, days, NOW, "r2")
    path = f"{lake}/gold/daily"
    assert rows(incremental.read_gold(spark, path)) != rows(gold_of(spark, lake))
    incremental.load_days(spark, late, lake, days, NOW, "r2")
    assert rows(incremental.read_gold(spark, path)) == rows(gold_of(spark, lake))


def test_the_sql_procedure_does_what_the_window_load_does(spark, rows, tmp_path):
    from ledgerlake.plans import procedure, windows

    feed = [
        *SEED,
        (100001, "2026-05-04", 9, 9, "SELL", "7", "10", "2026-05-04 20:00:00"),
        (100003, "2026-05-01", 3, 2, "BUY", "-1", "98.75", "2026-05-01 12:00:00"),
    ]
    sinks.publish_version(spark, trades(spark, feed), "proc_bronze", str(tmp_path / "b"))
    procedure.create_silver(spark, "proc_silver", str(tmp_path / "s"))
    silver, bronze = str(tmp_path / "w" / "silver"), trades(spark, feed)
    for day in ("2026-05-01", "2026-05-04", "2026-05-04", "2026-05-09"):
        told = procedure.call_window(spark, "proc_bronze", "proc_silver", day, NOW).first()
        assert told.asDict() == windows.transform_window(spark, bronze, silver, day, NOW)
    from ledgerlake.schemas import SILVER

    stored = spark.read.schema(SILVER).parquet(silver)
    assert rows(spark.table("proc_silver"), *SILVER.names) == rows(stored, *SILVER.names)
    spark.sql("DROP TABLE proc_silver")


# --- checks while writing, versions ---------------------------------------------------


def test_row_checks_need_no_scan(spark, tmp_path):
    suite = [c for c in quality.blotter_suite() if c.table == "silver_trades" and c.fails is not None]
    bad = trades(spark).withColumn("price", F.when(F.col("trade_id") % 2 == 0, F.col("price")))
    watched, seen = quality.watched(bad, [*suite, quality.check_not_null("silver_trades", "price")])
    sinks.write_parquet(watched, str(tmp_path / "w"))
    found = quality.watched_results(
        seen, [*suite, quality.check_not_null("silver_trades", "price")], {}
    )  # no table is given, so none is read
    assert {r.check_name: r.failing_rows for r in found} == {
        "not_null_silver_trades_trade_id": 0,
        "positive_value_silver_trades_quantity": 1,
        "positive_value_silver_trades_price": 0,
        "not_null_silver_trades_price": 5,
    }
    with pytest.raises(quality.ChecksFailed):
        quality.refuse_failed(found)


def test_a_failed_layer_leaves_the_old_one(spark, rows, tmp_path):
    lake = str(tmp_path / "lake")
    medallion.build(spark, trades(spark), traders(spark, JANUARY), lake, "2026-01-01", "kept")
    before = rows(spark.table("kept_gold_fact_trades_daily"))
    lost = traders(spark, JANUARY[1:])
    more = trades(spark, [*SEED, *LATER])
    with pytest.raises(quality.ChecksFailed):
        medallion.build(spark, more, lost, lake, "2026-07-01", "kept")
    assert rows(spark.table("kept_gold_fact_trades_daily")) == before


def test_a_version_is_shown_in_one_step(spark, rows, tmp_path):
    root = str(tmp_path / "versions")
    one = spark.createDataFrame([(1,)], "k int")
    sinks.publish_version(spark, one, "versioned", root, run="it's 1")
    assert sinks.version_property(spark, "versioned", "run") == "it's 1"
    sinks.write_version(one.union(one), root)  # stopped before the view moved
    assert rows(spark.table("versioned")) == [(1,)]
    doubled = spark.table("versioned").select((F.col("k") * 2).alias("k"))  # reads itself
    sinks.publish_version(spark, doubled, "versioned", root, run="2")
    assert rows(spark.table("versioned")) == [(2,)]
    assert sinks.version_property(spark, "versioned", "run") == "2"
    assert sinks.version_property(spark, "unknown_view", "run") is None


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    a = sinks.write_bucketed(fact, "bucketed_fact", 4, "k", path=str(tmp_path / "f"))
    b = sinks.write_bucketed(dim, "bucketed_dim", 4, "k", path=str(tmp_path / "d"))
    joined = a.join(b.hint("merge"), "k").groupBy("k").agg(F.sum("v").alias("v"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.agg(F.sum("v")).first()[0] == 20 * sum(2 * k for k in range(50))


def test_a_stored_view_holds_in_another_session(spark, rows, tmp_path):
    user = spark.range(1).select(F.session_user()).first()[0]
    logins = spark.createDataFrame([(1, user), (1, user), (2, "someone")], LOGINS)
    sinks.publish_version(spark, trades(spark), "held_fact", str(tmp_path / "f"))
    sinks.publish_version(spark, logins, "held_map", str(tmp_path / "m"))
    security.create_stored_secured_view(spark, "held_mine", "held_fact", "held_map")
    other = spark.newSession()
    seen = other.table("held_mine")
    assert seen.select("trader_id").distinct().collect()[0][0] == 1
    assert seen.count() == sum(r[3] == 1 for r in SEED)
    security.create_stored_secured_view(spark, "held_all", "held_fact", "held_map", [user, "o'x"])
    assert other.table("held_all").count() == len(SEED)
    security.create_stored_secured_view(spark, "held_none", "held_fact", "held_map", ["' or 1=1 --"])
    assert other.table("held_none").count() == seen.count()


def test_profiles_of_parts_add_up(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 8).alias("part"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 3000).alias("k"),
        F.concat(F.lit("n"), F.col("id") % 500).alias("name"),
    )
    first = sketches.part_profile(df.where("part < 7"), ["part"], ["k", "name"])
    late = sketches.part_profile(df.where("part = 7"), ["part"], ["k", "name"])
    found = {r.column_name: r for r in sketches.merged_profile(first.union(late)).collect()}
    k, name = found["k"], found["name"]
    assert (k.row_count, k.null_count, name.null_count) == (40_000, 4_000, 0)
    assert abs(k.distinct_estimate - 2700) < 0.06 * 2700 and abs(name.distinct_estimate - 500) < 30
    assert name.quantiles is None
    for q, value in zip(sketches.QUANTILES, k.quantiles, strict=True):
        assert abs(value / 3000 - q) < 0.03


# --- two-way ingest -------------------------------------------------------------------

SCHEMA = "trader_id long, trader_name string, desk string, region string"


def write(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_good_rows_and_rejects_are_the_lines(spark, rows, tmp_path):
    folder = tmp_path / "in"
    header = "trader_id,trader_name,desk,region"
    write(folder, "a.csv", header, '1,"A, B",Credit,APAC', "x,B,Credit,APAC", "3,C", "4,D,e,f,g")
    write(folder, "b.csv", header, ",E,Macro,", '6,"two\nlines",Macro,')
    write(folder, "c.csv", "trader_id,desk,trader_name,region", "7,F,Macro,EMEA")
    write(folder, "d.csv", header)
    good, rejects = ingest.read_landing_two_ways(spark, str(folder), TRADERS, ["trader_id"])
    assert rows(good.drop("_file")) == [(1, "A, B", "Credit", "APAC"), (6, "two\nlines", "Macro", None)]
    told = {(Path(r.file).name, r.line, r.reason) for r in rejects.collect()}
    assert {(f, why) for f, _, why in told} == {
        ("a.csv", "trader_id is not of type bigint"),
        ("a.csv", "wrong number of cells"),
        ("b.csv", "trader_id is missing"),
        ("c.csv", "wrong header"),
    }
    lines = {line for _, line, _ in told}
    assert {"x,B,Credit,APAC", "3,C", "4,D,e,f,g", "7,F,Macro,EMEA"} <= lines and len(told) == 6
    with pytest.raises(FileNotFoundError):
        ingest.read_landing_two_ways(spark, str(tmp_path / "none"), TRADERS)


def test_a_series_of_snapshot_files(spark, rows, tmp_path):
    root = tmp_path / "s"
    header = "trader_id,trader_name,desk,region"
    write(root, "dim_20260101.csv", header, "1,A,x,p", "2,B,x,p")
    write(root, "dim_20260601.csv", header, "1,A,y,p", "2,B,x,p", "z,B,x,p")
    write(root, "dim_latest.csv", header, "9,Z,x,p")
    good, rejects = ingest.read_snapshots(spark, str(root), "dim", TRADERS)
    versions = history.scd2_from_snapshots(good, "trader_id", ["desk"], "snapshot_date")
    assert rows(versions, "trader_id", "desk", "is_current") == [
        (1, "x", False), (1, "y", True), (2, "x", True),
    ]
    assert sorted(r.reason for r in rejects.collect()) == [
        "no date in the file's name", "trader_id is not of type bigint",
    ]


# --- arrivals with state --------------------------------------------------------------


def test_arrivals_with_state(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "id long, at timestamp_ntz, v string").schema
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        query = stateful.ingest_once(
            spark, str(folder), out, str(tmp_path / "cp"), schema, "at", "1 day", files_per_batch=1
        )
        query.awaitTermination()
        return (
            rows(stateful.read_rows(spark, out, schema), "id", "v"),
            sorted((Path(r.file).name, r.reason) for r in stateful.read_rejects(spark, out).collect()),
        )

    header = "id,at,v"
    write(folder, "1.csv", header, "1,2026-05-10 10:00:00,a", "1,2026-05-10 10:00:00,a", "x,2026-05-10 10:00:00,b")
    assert run() == ([(1, "a")], [("1.csv", "id is not of type bigint")])
    # a copy across runs, a new row within the watermark, a line without its time
    write(folder, "2.csv", header, "1,2026-05-10 10:00:00,a", "2,2026-05-10 09:00:00,b", "3,,c")
    found, told = run()
    assert found == [(1, "a"), (2, "b")] and ("2.csv", "at is missing") in told
    write(folder, "3.csv", header, "4,2026-06-10 10:00:00,d")  # moves the watermark
    run()
    # a late row, and a copy that is older than the state
    write(folder, "4.csv", header, "5,2026-05-10 10:00:00,e", "1,2026-05-10 10:00:00,a", "6,2026-06-10 09:00:00,f")
    found, told = run()
    assert found == [(1, "a"), (2, "b"), (4, "d"), (6, "f")]
    assert told == [
        ("1.csv", "id is not of type bigint"), ("2.csv", "at is missing"), ("4.csv", "late"),
    ]
    assert run() == (found, told)
    assert files.read_parquet(spark, f"{out}/rows").count() == 4


def test_exact_figures_hold_no_column_in_one_buffer(spark, monkeypatch):
    """Counts in ranges give what count_distinct and percentile give, and the query needs neither."""
    rows = [(i * 37 % 101, None if i % 9 == 0 else float(i % 17) / 4, "abc"[i % 3]) for i in range(700)]
    df = spark.createDataFrame(rows + [(None, None, None)], "a int, b double, c string")
    shares = (0.0, 0.45, 0.5, 0.55, 1.0)
    for column in ("a", "b"):
        wanted = df.agg(F.count_distinct(column), *(F.percentile(column, s) for s in shares)).first()
        n, found = sketches.counted_figures(sketches.ranged_counts(df, column).localCheckpoint(), shares)
        assert n == wanted[0] and found == pytest.approx(list(wanted[1:]))
    assert sketches.counted_figures(sketches.ranged_counts(df, "c").localCheckpoint()) == (3, [])
    none = sketches.ranged_counts(df.limit(0), "a").localCheckpoint()
    assert sketches.counted_figures(none, (0.5,)) == (0, [None])

    def refuse(*_):
        raise AssertionError("holds all values of a column at once")

    monkeypatch.setattr(F, "percentile", refuse)
    monkeypatch.setattr(F, "count_distinct", refuse)
    found = QUERIES["profile_from_sketches"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 4 and all(r.distinct_close and r.median_close for r in found)
