from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import JANUARY, JUNE, SEED, traders, trades
from ledgerlake import schemas
from ledgerlake.operators import upsert
from ledgerlake.plans import windows
from ledgerlake.session import shared_root, work_folder
from ledgerlake.sinks import tables as sinks
from ledgerlake.sources import files
from ledgerlake.sources import tables as catalog
from ledgerlake.streaming import arrivals

NOW = "2026-05-10 00:00:00"


def test_upsert_updates_only_the_named_columns(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, q int")
    source = spark.createDataFrame([(2, "z", 99), (3, "c", 30)], "k int, name string, q int")
    merged = upsert.upsert(target, source, ["k"], ["q"])
    assert rows(merged) == [(1, "a", 10), (2, "b", 99), (3, "c", 30)]


def test_upsert_can_set_null(spark, rows):
    target = spark.createDataFrame([(1, 10)], "k int, q int")
    source = spark.createDataFrame([(1, None)], target.schema)
    assert rows(upsert.upsert(target, source, ["k"], ["q"])) == [(1, None)]


def test_partitioned_upsert_rewrites_only_touched_folders(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, q int, d string"
    base = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], schema)
    upsert.upsert_partitions(spark, path, base, ["k"], ["q"], "d")
    before = {p.name for p in (tmp_path / "t" / "d=b").iterdir()}
    # key 1 now says it belongs to c: it is updated where it is stored
    change = spark.createDataFrame([(1, 9, "c"), (4, 4, "e")], schema)
    upsert.upsert_partitions(spark, path, change, ["k"], ["q"], "d")
    stored = spark.read.parquet(path).select("k", "q", "d")
    assert rows(stored) == [(1, 9, "a"), (2, 2, "b"), (3, 3, "c"), (4, 4, "e")]
    assert {p.name for p in (tmp_path / "t" / "d=b").iterdir()} == before


def moved_feed():
    """A trade that shows up in two windows, one corrected in its window, one turned bad."""
    return [
        *SEED,
        (100001, "2026-05-04", 9, 9, "SELL", "7", "10", "2026-05-04 20:00:00"),
        (100002, "2026-05-01", 2, 1, "SELL", "2500", "1625.50", "2026-05-01 12:00:00"),
        (100003, "2026-05-01", 3, 2, "BUY", "-1", "98.75", "2026-05-01 12:00:00"),
    ]


def test_windows_one_by_one_and_backfill_agree(spark, rows):
    bronze = trades(spark, moved_feed())
    lake = work_folder(spark, "lake")
    days = ["2026-05-06", "2026-05-05", "2026-05-01", "2026-05-04"]
    summaries = windows.run_windows(spark, bronze, lake, days, NOW)
    assert [tuple(s.values()) for s in summaries] == [
        ("2026-05-01", 5, 2),
        ("2026-05-04", 4, 3),
        ("2026-05-05", 3, 3),
        ("2026-05-06", 1, 0),
    ]
    silver = spark.read.schema(schemas.SILVER).parquet(f"{lake}/silver_table/trades")
    columns = schemas.SILVER.names
    assert rows(silver, *columns) == rows(windows.backfill(bronze, NOW), *columns)
    moved = silver.where("trade_id = 100001").first()
    assert (moved.trade_date, moved.trader_id) == (date(2026, 5, 1), 1)
    assert (moved.quantity, moved.trade_value) == (D(7), D("70.00"))
    # a rerun of a day changes nothing
    windows.run_windows(spark, bronze, lake, ["2026-05-05"], NOW)
    assert rows(spark.read.schema(schemas.SILVER).parquet(f"{lake}/silver_table/trades"), *columns) == rows(
        windows.backfill(bronze, NOW), *columns
    )
    copied = files.read_window(spark, f"{lake}/silver/trades", "2026-05-05")
    assert copied.count() == 3


def test_windows_together_equal_windows_one_by_one(spark, rows):
    bronze, columns = trades(spark, moved_feed()), schemas.SILVER.names
    lake = work_folder(spark, "lake")
    days = ["2026-05-06", "2026-05-05", "2026-05-01", "2026-05-04", "2026-05-09"]
    for _ in range(2):  # loading the same days again changes nothing
        found = windows.load_windows(spark, bronze, lake, days, NOW)
        assert [tuple(r) for r in found.orderBy("window_date").collect()] == [
            ("2026-05-01", 5, 2),
            ("2026-05-04", 4, 3),
            ("2026-05-05", 3, 3),
            ("2026-05-06", 1, 0),
            ("2026-05-09", 0, 0),
        ]
        silver = spark.read.schema(schemas.SILVER).parquet(f"{lake}/silver_table/trades")
        assert rows(silver, *columns) == rows(windows.backfill(bronze, NOW), *columns)
    assert files.read_window(spark, f"{lake}/silver/trades", "2026-05-05").count() == 3


def test_window_rewrite_leaves_other_days(spark, rows, tmp_path):
    root = str(tmp_path / "w")
    df = spark.createDataFrame([(1,)], "v int")
    for day, frame in (("2026-05-01", df), ("2026-05-02", df), ("2026-05-01", df.union(df))):
        sinks.write_window(frame, root, day)
    assert files.read_window(spark, root, "2026-05-01").count() == 2
    assert files.read_window(spark, root, "2026-05-02").count() == 1
    plan = files.read_window(spark, root, "2026-05-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert sorted(map(str, sinks.partition_values(spark, root, "window_date"))) == [
        "2026-05-01", "2026-05-02",
    ]


def test_csv_typed_inferred_and_corrupt(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(trades(spark), path)
    assert rows(files.read_csv(spark, path, schemas.TRADES)) == rows(trades(spark))
    assert dict(files.read_csv(spark, path).dtypes)["price"] == "double"
    (tmp_path / "bad.csv").write_text("id,n\n1,2\nx,3\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    read = files.read_csv(spark, str(tmp_path / "bad.csv"), schema, corrupt="_bad").cache()
    assert [r["_bad"] for r in read.collect()] == [None, "x,3"]


def test_landing_folder(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    with pytest.raises(FileNotFoundError):
        files.read_landing(spark, str(tmp_path / "none"), schema)
    landing = tmp_path / "landing"
    landing.mkdir()
    with pytest.raises(FileNotFoundError):
        files.require_input(spark, str(landing))
    for name, n in (("a.csv", 2), ("b.csv", 3)):
        (landing / name).write_text("id\n" + "".join(f"{i}\n" for i in range(n)))
    read = files.read_landing(spark, str(landing), schema)
    assert {r["_file"]: r["count"] for r in read.groupBy("_file").count().collect()} == {"a.csv": 2, "b.csv": 3}
    listed = files.file_inventory(spark, str(landing)).collect()
    assert {r.file_name: r.file_size for r in listed} == {"a.csv": 7, "b.csv": 9}


def test_snapshot_file_by_date(spark, rows, tmp_path):
    for day, raw in (("2026-01-01", JANUARY), ("2026-06-01", JUNE)):
        dated = traders(spark, raw).withColumn("snapshot_date", F.lit(day).cast("date"))
        sinks.write_csv(dated, files.snapshot_path(str(tmp_path), "dim_trader_snapshot", day))
    assert (tmp_path / "dim_trader_snapshot_20260601.csv").exists()
    read = files.read_snapshot(
        spark, str(tmp_path), "dim_trader_snapshot", date(2026, 6, 1), schemas.TRADER_SNAPSHOT
    )
    assert rows(read) == rows(traders(spark, JUNE))


def test_tables(spark, rows, tmp_path):
    dim = traders(spark, JANUARY)
    assert catalog.read_or_init(spark, "dim_hist", lambda: dim).count() == 6
    sinks.publish(spark, dim, "dim_hist")
    # a table that reads itself can be replaced
    grown = catalog.read_or_init(spark, "dim_hist", lambda: dim).union(traders(spark, JUNE[-1:]))
    sinks.publish(spark, grown, "dim_hist")
    assert catalog.read_table(spark, "dim_hist").count() == 7
    assert not spark.catalog.tableExists("dim_hist__next")
    outside = str(tmp_path / "outside")
    sinks.publish(spark, dim, "dim_outside", outside)
    twice = catalog.read_table(spark, "dim_outside").union(dim)
    sinks.publish(spark, twice, "dim_outside", outside)
    assert catalog.read_table(spark, "dim_outside").count() == 12
    sinks.write_csv(dim, str(tmp_path / "dim.csv"))
    assert catalog.load_seed(spark, str(tmp_path / "dim.csv"), "dim_seed").count() == 6
    assert catalog.bulk_load(spark, str(tmp_path / "dim.csv"), "dim_hist").count() == 13
    assert sinks.materialize(spark, dim, "dim_view", "view").count() == 6
    inline = catalog.inline_rows(spark, JANUARY, schemas.TRADERS)
    assert rows(inline) == rows(dim)
    for name in ("dim_hist", "dim_seed", "dim_outside"):
        spark.sql(f"drop table {name}")


def test_landing_copy_needs_another_folder(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(ValueError):
        sinks.land(df, str(tmp_path), str(tmp_path) + "/")
    sinks.land(df, str(tmp_path / "in"), str(tmp_path / "out"))
    assert files.read_parquet(spark, str(tmp_path / "out")).count() == 3


def test_clustered_write_and_load_date(spark, tmp_path):
    df = spark.range(100).withColumn("g", F.col("id") % 4)
    sinks.write_clustered(df, str(tmp_path / "c"), 4, "g")
    assert files.read_parquet(spark, str(tmp_path / "c")).count() == 100
    sinks.write_load_date(df, str(tmp_path / "l"), "2026-05-01")
    assert (tmp_path / "l" / "LoadDate=2026-05-01").exists()


def test_extract_reaches_the_scan(spark, tmp_path):
    sinks.write_parquet(trades(spark), str(tmp_path / "p"))
    wanted = files.extract_window(
        files.read_parquet(spark, str(tmp_path / "p")), "2026-05-05", ["trade_id"], "trade_date"
    )
    assert wanted.count() == 3
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(trade_date,2026-05-05)" in plan
    assert "ReadSchema: struct<trade_id:bigint,trade_date:date>" in plan


def test_arriving_files_are_loaded_once(spark, tmp_path):
    schema = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("amount", T.DecimalType(18, 2)),
        ]
    )
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()

    def deliver(name, *lines):
        (landing / name).write_text("id,name,amount\n" + "\n".join(lines) + "\n")
        arrivals.ingest_stream(
            spark, str(landing), out, str(tmp_path / "check"), schema, "2026-05-01", 1
        ).awaitTermination()
        return arrivals.read_ingested(spark, out).count()

    assert deliver("one.csv", "1,a,10.00", "1,a,10.00", "2,b,5.00") == 2
    assert deliver("two.csv", "2,b,5.00", "3,,1.00") == 3
    assert deliver("three.csv", "3,,1.00", "1,a,10.01") == 4
    (landing / "notes.txt").write_text("not a delivery")
    assert deliver("four.csv", "1,a,10.01") == 4


def test_retried_batch_adds_nothing(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, name string")
    for _ in range(2):
        arrivals.append_new(spark, batch, str(tmp_path / "out"), "2026-05-01")
    assert arrivals.read_ingested(spark, str(tmp_path / "out")).count() == 2


def test_arrivals_split_by_day(spark, tmp_path):
    out = str(tmp_path / "out")

    def load(*data):
        batch = spark.createDataFrame(data, "id int, t string").selectExpr(
            "id", "cast(t as timestamp_ntz) as at"
        )
        arrivals.append_new(spark, batch, out, "2026-05-01", "at")
        return arrivals.read_ingested(spark, out).count()

    assert load((1, "2026-01-01 10:00:00"), (1, "2026-01-01 10:00:00"), (2, None)) == 2
    assert load((1, "2026-01-01 10:00:00"), (1, "2026-01-02 10:00:00"), (2, None)) == 3
    assert load((1, "2026-01-01 11:00:00"), (1, "2026-01-02 10:00:00")) == 4
    assert (tmp_path / "out" / "LoadDate=2026-05-01" / "row_day=2026-01-02").exists()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "a") != work_folder(spark, "a")


def test_csv_keeps_every_cell(spark, rows, tmp_path):
    schema = "id long, note string, at timestamp_ntz"
    data = spark.createDataFrame(
        [
            (1, "a\nb", None),
            (2, "  pad  ", None),
            (3, "", None),
            (4, None, None),
            (5, 'say "x", y', None),
        ],
        schema,
    )
    sinks.write_csv(data, str(tmp_path / "cells"))
    assert rows(files.read_csv(spark, str(tmp_path / "cells"), data.schema)) == rows(data)


def test_csv_stamps_and_headers(spark, tmp_path):
    path = tmp_path / "stamps.csv"
    path.write_text("id,at\n1,2026-05-01 10:12:00.1230000\n2,2026-05-01T10:12:00\n3,2026-05-01 10:12:00\n")
    schema = spark.createDataFrame([], "id long, at timestamp_ntz").schema
    read = {r.id: str(r["at"]) for r in files.read_csv(spark, str(path), schema).collect()}
    assert read == {
        1: "2026-05-01 10:12:00.123000",
        2: "2026-05-01 10:12:00",
        3: "2026-05-01 10:12:00",
    }
    other = tmp_path / "other.csv"
    other.write_text("at,id\n2026-05-01 10:12:00,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(other), schema).collect()


def test_rows_a_microsecond_apart_both_stay(spark, tmp_path):
    out = str(tmp_path / "out")
    for stamp in ("2026-05-01 10:00:00.000001", "2026-05-01 10:00:00.000002"):
        batch = spark.sql(f"select 1 as id, timestamp_ntz'{stamp}' as at")
        arrivals.append_new(spark, batch, out, "2026-05-01", "at")
    assert arrivals.read_ingested(spark, out).count() == 2


def test_upsert_keeps_rows_without_a_partition(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, v long, d date"
    for batch in ([(1, 10, None), (2, 20, None)], [(3, 30, None), (2, 21, None)]):
        upsert.upsert_partitions(spark, path, spark.createDataFrame(batch, schema), ["id"], ["v"], "d")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, 10), (2, 21), (3, 30)]
    with pytest.raises(ValueError, match="folder"):
        upsert.upsert_partitions(spark, path, spark.createDataFrame([], schema), ["id"], ["d"], "d")


def test_a_stop_between_renames_loses_nothing(spark):
    sinks.publish(spark, spark.range(3).toDF("id"), "renamed_halfway")
    spark.sql("ALTER TABLE renamed_halfway RENAME TO renamed_halfway__previous")
    kept = catalog.read_or_init(spark, "renamed_halfway", lambda: spark.range(0).toDF("id"))
    assert kept.count() == 3
    spark.sql("ALTER TABLE renamed_halfway RENAME TO renamed_halfway__previous")
    sinks.publish(spark, spark.range(5).toDF("id"), "renamed_halfway")
    assert spark.table("renamed_halfway").count() == 5
    spark.sql("DROP TABLE renamed_halfway")


def test_first_load_reads_its_source_once(spark, rows, tmp_path, monkeypatch):
    """No known keys are looked for in an empty table; a second load finds them again."""
    looked, look = [], upsert.touched_partitions
    monkeypatch.setattr(upsert, "touched_partitions", lambda *a: looked.append(1) or look(*a))
    day = date(2024, 1, 2)
    source = trades(spark, [(1, "2024-01-02", 7, 8, "BUY", "3", "2", "2024-01-02 10:00:00")])
    lake = str(tmp_path / "lake")
    for times in (0, 1):
        done = windows.load_windows(spark, source, lake, [day], NOW)
        assert rows(done) == [("2024-01-02", 1, 1)]
        assert len(looked) == times
        assert spark.read.parquet(f"{lake}/silver/trades").count() == 1
