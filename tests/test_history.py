import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixtures import (
    AMENDED_VALUES,
    AMENDMENTS,
    JANUARY,
    JUNE,
    SEPTEMBER,
    amendments,
    traders,
)
from ledgerlake.functions.columns import with_trade_value
from ledgerlake.operators import history as h
from ledgerlake.operators import joins
from ledgerlake.sinks import tables as sinks

STATE = ["desk", "region"]


def first(spark):
    return h.scd2_init(traders(spark, JANUARY), "2026-01-01")


def after_june(spark):
    return h.scd2_apply(first(spark), traders(spark, JUNE), "trader_id", STATE, "2026-06-01")


def after_september(spark):
    batch = traders(spark, SEPTEMBER)
    return h.scd2_apply(after_june(spark), batch, "trader_id", STATE, "2026-09-01")


def test_first_batch(spark, rows):
    table = after_june(spark)
    assert table.count() == 10 and h.current(table).count() == 7
    closed = h.historical(table)
    assert rows(closed, "trader_id") == [(4,), (5,), (6,)]
    assert {r.valid_to for r in closed.collect()} == {date(2026, 5, 31)}
    changes = h.scd2_changes(first(spark), traders(spark, JUNE), "trader_id", STATE)
    assert rows(changes) == [(4, "changed"), (5, "changed"), (6, "changed"), (7, "new")]


def test_second_batch_gives_three_versions(spark):
    table = after_september(spark)
    assert table.count() == 13 and h.current(table).count() == 8
    versions = h.history_of(table, F.col("trader_id") == 4, "trader_id").collect()
    assert [r.desk for r in versions] == ["Macro", "Credit", "Equities"]
    assert [r.valid_to for r in versions] == [date(2026, 5, 31), date(2026, 8, 31), date(9999, 12, 31)]


@pytest.mark.parametrize(
    "day,desk",
    [("2026-03-15", "Macro"), ("2026-06-01", "Credit"), ("2026-08-31", "Credit"), ("2026-09-01", "Equities")],
)
def test_point_in_time(spark, day, desk):
    assert joins.as_of(after_september(spark), day).where("trader_id = 4").first().desk == desk


def test_replayed_batch_changes_nothing(spark, rows):
    table = after_september(spark)
    again = h.scd2_apply(table, traders(spark, SEPTEMBER), "trader_id", STATE, "2026-09-01")
    assert rows(again) == rows(table)


def test_late_batch_is_refused_and_reported(spark, rows):
    table = after_september(spark)
    late = traders(spark, JUNE)
    assert rows(h.scd2_apply(table, late, "trader_id", STATE, "2026-06-01")) == rows(table)
    refused = h.scd2_refused(table, late, "trader_id", STATE, "2026-06-01")
    assert rows(refused, "trader_id") == [(4,), (7,)]


def test_fold_equals_one_by_one(spark, rows):
    batches = [("2026-06-01", traders(spark, JUNE)), ("2026-09-01", traders(spark, SEPTEMBER))]
    folded = h.scd2_fold(first(spark), batches, "trader_id", STATE)
    assert rows(folded) == rows(after_september(spark))
    with pytest.raises(ValueError):
        h.scd2_fold(first(spark), [batches[0], batches[0]], "trader_id", STATE)


def test_steps_equal_the_single_join(spark, rows):
    now, batch = first(spark), traders(spark, JUNE)
    changes = h.scd2_changes(now, batch, "trader_id", STATE)
    stepwise = h.assemble(
        h.scd2_keep(now, changes, "trader_id"),
        h.scd2_close(now, changes, "trader_id", "2026-06-01"),
        h.scd2_open(batch, changes, "trader_id", "2026-06-01"),
    )
    assert rows(stepwise) == rows(after_june(spark))


def test_null_changes(spark, rows):
    old = h.scd2_init(traders(spark, [(1, "t", None, "x"), (2, "t", "d", "x")]), "2026-01-01")
    new = traders(spark, [(1, "t", "Q", "x"), (2, "t", None, "x")])
    safe = h.scd2_changes(old, new, "trader_id", STATE)
    unsafe = h.scd2_changes(old, new, "trader_id", STATE, null_safe=False)
    assert rows(safe, "trader_id") == [(1,), (2,)] and unsafe.isEmpty()


def test_key_missing_from_the_snapshot_stays_current(spark):
    table = h.scd2_apply(first(spark), traders(spark, JUNE[:1]), "trader_id", STATE, "2026-06-01")
    assert table.count() == 6 and h.current(table).count() == 6


def random_batches(seed, keys=9, batches=6):
    rng = random.Random(seed)
    out = []
    for i in range(batches):
        day = date(2026, 1, 2) + timedelta(days=7 * i)
        present = [k for k in range(keys) if rng.random() < 0.7]
        out.append((day, [(k, f"t{k}", rng.choice(["a", "b", None]), rng.choice("xy")) for k in present]))
    return out


def brute(initial, load, batches):
    """Plain loop over batches: the versions per key."""
    versions = {k: [[load, None, (d, r)]] for k, _, d, r in initial}
    for day, snapshot in batches:
        for k, _, d, r in snapshot:
            held = versions.setdefault(k, [])
            if held and held[-1][2] == (d, r):
                continue
            if held:
                held[-1][1] = day - timedelta(days=1)
            held.append([day, None, (d, r)])
    end = date(9999, 12, 31)
    return {
        (k, a, z or end, *state, z is None) for k, vs in versions.items() for a, z, state in vs
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_batches_against_a_plain_loop(spark, seed):
    initial = [(k, f"t{k}", "a", "x") for k in range(4)]
    batches = random_batches(seed)
    wanted = brute(initial, date(2026, 1, 1), batches)
    start = h.scd2_init(traders(spark, initial), "2026-01-01")
    frames = [(d, traders(spark, s)) for d, s in batches]

    def shape(table):
        cols = ("trader_id", "valid_from", "valid_to", "desk", "region", "is_current")
        return {tuple(r) for r in table.select(*cols).collect()}

    assert shape(h.scd2_fold(start, frames, "trader_id", STATE)) == wanted
    table = start
    for d, s in frames:
        table = h.scd2_apply(table, s, "trader_id", STATE, d).checkpoint()
    assert shape(table) == wanted
    report = h.check_history(table, "trader_id")
    assert report.where("not consistent").isEmpty() and not report.isEmpty()


@pytest.mark.parametrize(
    "versions",
    [
        [("2026-01-01", "2026-01-31", False), ("2026-02-02", "9999-12-31", True)],  # gap
        [("2026-01-01", "2026-02-05", False), ("2026-02-01", "9999-12-31", True)],  # overlap
        [("2026-01-01", "9999-12-31", True), ("2026-01-01", "9999-12-31", True)],  # two current
        [("2026-01-01", "2026-01-31", False)],  # none current
        [("2026-03-01", "2026-02-01", False), ("2026-02-02", "9999-12-31", True)],  # backwards
        [("2026-01-01", "9999-12-31", False)],  # flag disagrees
    ],
)
def test_broken_histories_are_found(spark, versions):
    bad = spark.createDataFrame(
        [(1, *v) for v in versions] + [(2, "2026-01-01", "9999-12-31", True)],
        "k int, a string, z string, is_current boolean",
    ).selectExpr("k", "cast(a as date) valid_from", "cast(z as date) valid_to", "is_current")
    report = {r.k: r.consistent for r in h.check_history(bad, "k").collect()}
    assert report == {1: False, 2: True}


def test_stored_history_replaces_two_folders_per_batch(spark, rows, tmp_path):
    path = str(tmp_path / "history")
    sinks.write_history(first(spark), path)
    for day, batch in (("2026-06-01", JUNE), ("2026-09-01", SEPTEMBER), ("2026-09-01", SEPTEMBER)):
        table = spark.read.parquet(path)
        after = h.scd2_apply(table, traders(spark, batch), "trader_id", STATE, day)
        sinks.write_history(sinks.changed_versions(after, day), path)
    stored = spark.read.parquet(path).select(*after_september(spark).columns)
    assert rows(stored) == rows(after_september(spark))


# --- amendments -------------------------------------------------------------------------


def book(spark):
    """The amended trades as first booked, and one that is never amended."""
    was = [(*t[:5], str(int(t[5]) * 10), t[6], t[7]) for t in AMENDMENTS]
    other = (1, "2026-05-01", 1, 1, "BUY", "1", "1", "-")
    booked = amendments(spark, [*was, other]).drop("amendment_reason", "amendment_date")
    table = h.scd2_init(with_trade_value(booked), "2026-01-01")
    return table.withColumn("amendment_reason", F.lit(None).cast("string"))


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_amendments(spark, limit):
    table = h.apply_amendments(book(spark), amendments(spark), "2026-05-20", limit=limit)
    assert table.count() == 11
    opened = {r.trade_id: r for r in table.where("valid_from = '2026-05-20'").collect()}
    assert {k: r.trade_value for k, r in opened.items()} == AMENDED_VALUES
    assert all(r.is_current and r.amendment_reason for r in opened.values())
    closed = h.historical(table).collect()
    assert {r.valid_to for r in closed} == {date(2026, 5, 19)}
    assert all(r.amendment_reason is None for r in closed)
    old = joins.as_of(table, "2026-05-10").where("trade_id = 100015").first()
    assert (old.quantity, old.trade_value) == (D(900), D("811989.00"))


def test_amendments_replayed_repeated_and_unknown(spark, rows):
    table = h.apply_amendments(book(spark), amendments(spark), "2026-05-20")
    again = h.apply_amendments(table, amendments(spark), "2026-05-20")
    assert rows(again) == rows(table)
    twice = amendments(spark, [AMENDMENTS[0], (*AMENDMENTS[0][:5], "80", *AMENDMENTS[0][6:])])
    one = h.apply_amendments(book(spark), twice, "2026-05-20")
    assert h.current(one).where("trade_id = 100015").count() == 1
    stranger = amendments(spark, [(999, *AMENDMENTS[0][1:])])
    assert rows(h.apply_amendments(book(spark), stranger, "2026-05-20")) == rows(book(spark))
    assert rows(h.unknown_amendments(book(spark), stranger), "trade_id") == [(999,)]


# --- point-in-time joins ----------------------------------------------------------------


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_join_as_of_takes_the_version_of_the_day(spark, rows, limit):
    days = ["2025-12-31", "2026-03-15", "2026-05-31", "2026-06-01", "2026-08-31", "2026-09-01", "2027-01-01"]
    fact = spark.createDataFrame([(i, 4, d) for i, d in enumerate(days)], "id int, trader_id long, d string")
    fact = fact.withColumn("d", F.col("d").cast("date"))
    out = joins.join_as_of(fact, after_september(spark), "trader_id", "d", limit=limit)
    assert [r[1] for r in rows(out, "id", "desk")] == [
        None, "Macro", "Macro", "Credit", "Credit", "Equities", "Equities",
    ]
    inner = joins.join_as_of(fact, after_september(spark), "trader_id", "d", "inner", limit=limit)
    assert inner.count() == 6


@pytest.mark.parametrize("seed", [4, 5])
def test_join_as_of_both_ways_against_a_plain_loop(spark, rows, seed):
    rng = random.Random(seed)
    initial = [(k, f"t{k}", "a", "x") for k in range(6)]
    start = h.scd2_init(traders(spark, initial), "2026-01-01")
    batches = random_batches(seed)
    table = h.scd2_fold(start, [(d, traders(spark, s)) for d, s in batches], "trader_id", STATE)
    raw = [
        (
            i,
            rng.choice([None, *range(10)]),
            None if rng.random() < 0.1 else date(2025, 12, 20) + timedelta(days=rng.randrange(90)),
        )
        for i in range(300)
    ]
    fact = spark.createDataFrame(raw, "id int, trader_id long, d date")
    versions = [tuple(r) for r in table.select("trader_id", "valid_from", "valid_to", "desk").collect()]
    wanted = sorted(
        (
            i,
            next((f for t, f, z, _ in versions if d and t == k and f <= d <= z), None),
            next((s for t, f, z, s in versions if d and t == k and f <= d <= z), None),
        )
        for i, k, d in raw
    )
    for limit in (0, joins.BROADCAST_LIMIT):
        joined = joins.join_as_of(fact, table, "trader_id", "d", limit=limit)
        found = sorted(tuple(r) for r in joined.select("id", "valid_from", "desk").collect())
        assert found == wanted


def test_join_current_does_not_multiply(spark):
    fact = spark.createDataFrame([(1, 4), (2, 4), (3, 8)], "id int, trader_id long")
    joined = joins.join_current(fact, after_september(spark), "trader_id")
    assert joined.count() == 3 and {r.desk for r in joined.collect()} == {"Equities", "Macro"}


# --- open-ended snapshots ---------------------------------------------------------------


def test_check_snapshot(spark):
    cols = ["desk", "region", "trader_name"]
    table = h.snapshot_init(traders(spark, JANUARY), "trader_id", "2026-01-01 00:00:00")
    for _ in range(2):  # the second run of a batch is a replay
        table = h.snapshot_check(
            table, traders(spark, JUNE), "trader_id", cols, "2026-06-01 08:00:00"
        ).checkpoint()
        assert table.count() == 10
        assert table.where("dbt_valid_to is null").count() == 7
    assert table.select("dbt_scd_id").distinct().count() == 10
    at = h.snapshot_as_of(table, "2026-06-01 07:59:59").where("trader_id = 4").first()
    assert at.desk == "Macro"
    assert h.snapshot_as_of(table, "2026-06-01 08:00:00").where("trader_id = 4").first().desk == "Credit"


def test_timestamp_snapshot(spark, rows):
    schema = "id int, v string, at timestamp_ntz"
    def frame(*data):
        return spark.createDataFrame(data, "id int, v string, t string").selectExpr(
            "id", "v", "cast(t as timestamp_ntz) as at"
        )
    first_run = frame((1, "a", "2026-01-01 00:00:00"), (2, "b", "2026-01-01 00:00:00"))
    table = h.snapshot_init(first_run, "id", F.col("at"))
    # changed text without a later time is not a new version
    source = frame((1, "z", "2026-01-01 00:00:00"), (2, "c", "2026-02-01 00:00:00"))
    after = h.snapshot_timestamp(table, source, "id", "at")
    assert rows(after, "id", "v") == [(1, "a"), (2, "b"), (2, "c")]
    assert rows(after.where("dbt_valid_to is not null"), "id", "v") == [(2, "b")]


# --- guards -----------------------------------------------------------------------------


def test_as_of_join_is_the_same_on_both_paths(spark, rows):
    table = after_september(spark)
    fact = spark.createDataFrame(
        [(1, 1, None), (2, 1, date(1990, 1, 1)), (3, 4, date(2026, 7, 1)), (4, None, date(2026, 7, 1))],
        "id int, trader_id long, d date",
    )
    for how in ("left", "inner"):
        for df in (fact, fact.limit(0)):
            small, large = (
                joins.join_as_of(df, table, "trader_id", "d", how, limit)
                for limit in (joins.BROADCAST_LIMIT, 0)
            )
            assert rows(small) == rows(large)
    for how in ("right", "full"):
        with pytest.raises(ValueError, match="left or inner"):
            joins.join_as_of(fact, table, "trader_id", "d", how)


def test_repeated_and_missing_keys_are_not_lost(spark):
    table, batch = after_june(spark), traders(spark, SEPTEMBER)
    with pytest.raises(ValueError, match="repeats"):
        h.scd2_apply(table, batch.union(batch), "trader_id", STATE, "2026-09-01")
    keyless = batch.limit(1).withColumn("trader_id", F.lit(None).cast("long"))
    refused = h.scd2_refused(table, batch.unionByName(keyless), "trader_id", STATE, "2026-09-01")
    assert [r.trader_id for r in refused.collect()] == [None]
