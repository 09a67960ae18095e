"""Versioned tables (type 2 history) for dimensions and facts.

A version is valid on every day from valid_from to valid_to, both included. A batch
dated d closes a version on d - 1. The current version ends at END_OF_TIME.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.functions.columns import (
    END_OF_TIME,
    day,
    day_before,
    differs,
    with_trade_value,
)
from ledgerlake.operators.conform import BLOTTER_TIES, latest_per_key
from ledgerlake.operators.joins import BROADCAST_LIMIT, drop_keys, keep_keys, sized

VALIDITY = ("valid_from", "valid_to", "is_current")


def forever() -> Column:
    return F.lit(END_OF_TIME).cast("date")


def scd2_init(df: DataFrame, load_date) -> DataFrame:
    """First load: every row is the current version since the load date."""
    return df.withColumns(
        {"valid_from": day(load_date), "valid_to": forever(), "is_current": F.lit(True)}
    )


def current(history: DataFrame) -> DataFrame:
    """Versions valid until further notice.

    The end of validity is named as well: stored history is partitioned by it, so only
    the folder of current versions is read.
    """
    endless = (F.col("valid_to") == forever()) | F.col("valid_to").isNull()
    return history.where(F.col("is_current") & endless)


def historical(history: DataFrame) -> DataFrame:
    """All other versions, those without a mark included."""
    return history.where(~F.coalesce("is_current", F.lit(False)))


def unrepeated(snapshot: DataFrame, key: str) -> DataFrame:
    """The snapshot, refused if it holds a key twice: both rows would become current."""
    if not snapshot.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} repeats in the snapshot; reduce it with latest_per_key")
    return snapshot


def scd2_changes(
    current_rows: DataFrame,
    snapshot: DataFrame,
    key: str,
    compare: Sequence[str],
    null_safe: bool = True,
) -> DataFrame:
    """(key, kind) for every snapshot key that is 'new' or 'changed'.

    A key the snapshot lacks is not a change: its current version stays.
    """
    old = current_rows.select(key, *compare).withColumn("_known", F.lit(True)).alias("old")
    new = snapshot.select(key, *compare).where(F.col(key).isNotNull()).alias("new")
    fresh = F.col("old._known").isNull()
    changed = ~fresh & differs(compare, "old", "new", null_safe)
    return (
        new.join(old, F.col(f"new.{key}") == F.col(f"old.{key}"), "left")
        .where(fresh | changed)
        .select(f"new.{key}", F.when(fresh, "new").otherwise("changed").alias("kind"))
    )


def scd2_close(current_rows: DataFrame, changes: DataFrame, key: str, batch_date) -> DataFrame:
    """The replaced versions, ended the day before the batch."""
    return keep_keys(current_rows, changes, [key]).withColumns(
        {"valid_to": day_before(batch_date), "is_current": F.lit(False)}
    )


def scd2_keep(current_rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Current versions the batch does not touch."""
    return drop_keys(current_rows, changes, [key])


def scd2_open(snapshot: DataFrame, changes: DataFrame, key: str, batch_date) -> DataFrame:
    """The new current versions."""
    return scd2_init(keep_keys(snapshot, changes, [key]), batch_date)


def assemble(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Union by name; columns a part lacks become NULL."""
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def _paired(old: DataFrame, new: DataFrame, key: str, how: str) -> DataFrame:
    """Both sides as structs ``old`` and ``new``; NULL where a side has no row."""
    return old.select(key, F.struct("*").alias("old")).join(
        new.where(F.col(key).isNotNull()).select(key, F.struct("*").alias("new")), key, how
    )


def _replace(
    pairs: DataFrame,
    like: DataFrame,
    opens: Column,
    closing: Mapping[str, Column],
    opening: Mapping[str, Column],
) -> DataFrame:
    """One or two rows per pair: the old version, ended if replaced, and the new one.

    Both come out of the same joined row, so a batch costs one join however many
    of the four kinds of row (kept, ended, changed, new) it holds.
    """
    has_old = F.col("old").isNotNull()
    replaced = has_old & opens
    incoming = set(pairs.schema["new"].dataType.names)
    kept, opened = [], []
    for f in like.schema:
        was = F.col(f"old.{f.name}")
        kept.append(
            (F.when(replaced, closing[f.name]).otherwise(was) if f.name in closing else was)
            .cast(f.dataType)
            .alias(f.name)
        )
        now = F.col(f"new.{f.name}") if f.name in incoming else F.lit(None)
        opened.append(opening.get(f.name, now).cast(f.dataType).alias(f.name))
    rows = F.array(F.when(has_old, F.struct(*kept)), F.when(opens, F.struct(*opened)))
    return pairs.select(F.inline(F.array_compact(rows)))


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    compare: Sequence[str],
    batch_date,
    null_safe: bool = True,
) -> DataFrame:
    """History after one dated snapshot, which must hold at most one row per key.

    Applying the same batch again changes nothing. A change dated on or before the
    start of the version it would replace is refused; ``scd2_refused`` returns those.
    """
    pairs = _paired(current(history), unrepeated(snapshot, key), key, "full_outer")
    opens = F.col("old").isNull() | (
        F.col("new").isNotNull()
        & differs(compare, "old", "new", null_safe)
        & (F.col("old.valid_from") < day(batch_date))
    )
    moved = _replace(
        pairs,
        history,
        opens,
        {"valid_to": day_before(batch_date), "is_current": F.lit(False)},
        {"valid_from": day(batch_date), "valid_to": forever(), "is_current": F.lit(True)},
    )
    return historical(history).unionByName(moved)


def scd2_refused(
    history: DataFrame, snapshot: DataFrame, key: str, compare: Sequence[str], batch_date
) -> DataFrame:
    """Snapshot rows that a batch leaves out: those without a key, and those too late to
    apply, which differ from a version as new as the batch."""
    newer = current(history).where(F.col("valid_from") >= day(batch_date))
    pairs = _paired(newer, snapshot, key, "inner")
    late = pairs.where(differs(compare, "old", "new")).select("new.*")
    return late.unionByName(snapshot.where(F.col(key).isNull()))


def _chained(states: DataFrame, key: str, compare: Sequence[str], date: str) -> DataFrame:
    """Dated states of each key, one per date, reduced to versions that follow each other.

    A state equal to the one before it starts no version. A key's group is at most as
    long as the number of dates, so one shuffle by key does it all. A key that is there
    twice on one date would end a version before it starts: the run fails instead, found
    in the same window.
    """
    by_date = W.partitionBy(key).orderBy(date)
    state, before = F.struct(*compare), F.lag(date).over(by_date)
    repeated = F.raise_error(f"{key} repeats on one date; reduce the rows with latest_per_key")
    starts = F.when(before == F.col(date), repeated.cast("boolean")).otherwise(
        before.isNull() | ~F.lag(state).over(by_date).eqNullSafe(state)
    )
    versions = states.withColumn("_starts", starts).where("_starts").drop("_starts")
    ends = F.date_sub(F.lead(date).over(by_date), 1)
    return versions.withColumn("valid_to", F.coalesce(ends, forever())).withColumns(
        {"valid_from": F.col(date), "is_current": F.col("valid_to") == forever()}
    )


def scd2_from_snapshots(
    snapshots: DataFrame, key: str, compare: Sequence[str], date: str
) -> DataFrame:
    """The history of a whole series of dated snapshots in one pass.

    A key twice on one date fails the run. Equals applying the snapshots one by one.
    """
    states = snapshots.where(F.col(key).isNotNull())
    return _chained(states, key, compare, date).drop(date)


def scd2_fold(
    history: DataFrame,
    batches: Iterable[tuple[object, DataFrame]],
    key: str,
    compare: Sequence[str],
) -> DataFrame:
    """History after several dated snapshots, as if ``scd2_apply`` ran for each in turn.

    All batches are chained at once: one shuffle, however many there are. A snapshot
    row not later than the key's current version is left out, as it would be refused, and
    so is one without a key: ``scd2_fold_refused`` returns those. A key twice in one
    snapshot fails the run.
    """
    dated = sorted(batches, key=lambda batch: str(batch[0]))
    if len({str(d) for d, _ in dated}) < len(dated):
        raise ValueError("two batches carry the same date")
    states = current(history).withColumns({"_date": F.col("valid_from"), "_known": F.lit(True)})
    for batch_date, snapshot in dated:
        rows = snapshot.where(F.col(key).isNotNull()).withColumns(
            {"_date": day(batch_date), "_known": F.lit(False)}
        )
        states = states.unionByName(rows, allowMissingColumns=True)
    since = F.max(F.when(F.col("_known"), F.col("_date"))).over(W.partitionBy(key))
    timely = F.col("_known") | F.col("_since").isNull() | (F.col("_date") > F.col("_since"))
    chained = _chained(states.withColumn("_since", since).where(timely), key, compare, "_date")
    return historical(history).unionByName(chained.select(history.columns))


def scd2_fold_refused(
    history: DataFrame,
    batches: Iterable[tuple[object, DataFrame]],
    key: str,
    compare: Sequence[str],
) -> DataFrame:
    """The rows of all snapshots that ``scd2_fold`` leaves out, with batch_date and reason.

    A row is late if it differs from a current version as new as its batch; versions that
    earlier batches of the series open are older than later batches, so the history before
    the fold decides. One join, however many batches there are.
    """
    dated = [df.withColumn("batch_date", day(d)) for d, df in batches]
    rows = assemble(*dated)
    unkeyed = rows.where(F.col(key).isNull()).withColumn("reason", F.lit("no key"))
    pairs = _paired(current(history), rows, key, "inner")
    late = pairs.where(
        (F.col("new.batch_date") <= F.col("old.valid_from")) & differs(compare, "old", "new")
    )
    return late.select("new.*").withColumn("reason", F.lit("late")).unionByName(unkeyed)


def history_of(history: DataFrame, keys: DataFrame | Column, key: str) -> DataFrame:
    """Every version of the wanted keys, oldest first."""
    rows = history.where(keys) if isinstance(keys, Column) else keep_keys(history, keys, [key])
    return rows.orderBy(key, "valid_from")


def check_history(history: DataFrame, key: str) -> DataFrame:
    """Per key: versions, current versions, and whether they cover time exactly once.

    A version adds one on valid_from and takes one away after valid_to. Where versions
    follow each other the two cancel, so an unbroken history leaves only its first and
    last edge. Sums per (key, edge) need no window over a key's versions.
    """
    starts = F.struct(F.unix_date("valid_from").alias("edge"), F.lit(1).alias("step"))
    ends = F.struct((F.unix_date("valid_to") + 1).alias("edge"), F.lit(-1).alias("step"))
    wrong = (F.col("valid_from") > F.col("valid_to")) | (
        F.col("is_current") != (F.col("valid_to") == forever())
    )
    edges = history.select(
        key,
        "is_current",
        F.coalesce(wrong, F.lit(True)).alias("wrong"),
        F.inline(F.array(starts, ends)),
    )
    start = F.col("step") == 1
    net = edges.groupBy(key, "edge").agg(
        F.sum("step").alias("net"),
        F.count_if(start).alias("versions"),
        F.count_if(start & F.col("is_current")).alias("current_versions"),
        F.count_if(start & F.col("wrong")).alias("wrong_versions"),
    )
    per_key = net.groupBy(key).agg(
        F.sum("versions").alias("versions"),
        F.sum("current_versions").alias("current_versions"),
        F.sum("wrong_versions").alias("wrong_versions"),
        F.sum(F.abs("net")).alias("loose_edges"),
    )
    return per_key.withColumn(
        "consistent",
        (F.col("current_versions") == 1)
        & (F.col("wrong_versions") == 0)
        & (F.col("loose_edges") == 2),
    )


# --- amendments of facts -----------------------------------------------------------

AMENDED = BLOTTER_TIES


def newest_amendments(amendments: DataFrame, key: str = "trade_id") -> DataFrame:
    """One correction per trade: the latest dated, with its value computed again."""
    one = latest_per_key(amendments, [key], ["amendment_date"], [*AMENDED, "amendment_reason"])
    return with_trade_value(one)


def apply_amendments(
    history: DataFrame,
    amendments: DataFrame,
    batch_date,
    key: str = "trade_id",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Fact history after a batch of corrections.

    Only known trades are amended (``unknown_amendments`` returns the others), so the
    fact side is preserved and a batch that measures small is broadcast to it: the fact
    is not shuffled. A correction equal to the current version opens nothing.
    """
    batch = newest_amendments(amendments, key)
    small_batch = sized(batch, limit)
    pairs = _paired(current(history), small_batch, key, "left")
    opens = (
        F.col("new").isNotNull()
        & differs(AMENDED, "old", "new")
        & (F.col("old.valid_from") < day(batch_date))
    )
    moved = _replace(
        pairs,
        history,
        opens,
        {"valid_to": day_before(batch_date), "is_current": F.lit(False)},
        {"valid_from": day(batch_date), "valid_to": forever(), "is_current": F.lit(True)},
    )
    return historical(history).unionByName(moved)


def unknown_amendments(
    history: DataFrame, amendments: DataFrame, key: str = "trade_id"
) -> DataFrame:
    """Corrections of trades that are not in the book."""
    return drop_keys(amendments, current(history).select(key), [key])


# --- snapshots with an open end ----------------------------------------------------

SNAPSHOT_COLUMNS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _scd_id(key: Column, at: Column) -> Column:
    stamp = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", key.cast("string"), stamp))


def _stamp(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def snapshot_init(source: DataFrame, key: str, at) -> DataFrame:
    """First snapshot: every row open since ``at`` (a time, or the source's own column)."""
    since = _stamp(at)
    return source.withColumns(
        {
            "dbt_scd_id": _scd_id(F.col(key), since),
            "dbt_updated_at": since,
            "dbt_valid_from": since,
            "dbt_valid_to": F.lit(None).cast("timestamp_ntz"),
        }
    )


def _snapshot(history, source, key, opens, since) -> DataFrame:
    is_open = F.col("dbt_valid_to").isNull()
    pairs = _paired(history.where(is_open), source, key, "full_outer")
    moved = _replace(
        pairs,
        history,
        F.col("old").isNull() | (F.col("new").isNotNull() & opens),
        {"dbt_valid_to": since},
        {
            "dbt_scd_id": _scd_id(F.col(key), since),
            "dbt_updated_at": since,
            "dbt_valid_from": since,
            "dbt_valid_to": F.lit(None),
        },
    )
    return history.where(~is_open).unionByName(moved)


def snapshot_check(
    history: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], run_ts
) -> DataFrame:
    """New version when any checked column differs; the current version has no end."""
    since = _stamp(run_ts)
    opens = differs(check_cols, "old", "new") & (F.col("old.dbt_valid_from") < since)
    return _snapshot(history, source, key, opens, since)


def snapshot_timestamp(
    history: DataFrame, source: DataFrame, key: str, updated_at: str
) -> DataFrame:
    """New version when the source's own modification time is later."""
    since = F.col(f"new.{updated_at}")
    return _snapshot(history, source, key, since > F.col("old.dbt_updated_at"), since)


def snapshot_as_of(history: DataFrame, at) -> DataFrame:
    """The rows true at one moment; the end of a version is not part of it."""
    t = _stamp(at)
    return history.where(
        (F.col("dbt_valid_from") <= t)
        & (F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_to") > t))
    )
