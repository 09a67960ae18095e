"""Exact duplicates by deterministic block naming.

A text is cut into blocks of BLOCK bytes. Equal blocks get the same integer and
different blocks different ones, by their rank in a sort. Then the names of adjacent
blocks are named as pairs, level by level, until a document has a single name. Names
stand for contents and not for hashes of them, so two documents have the same name at
the same level only if their texts are equal, byte for byte.

A hash of a block only decides which task sorts it. Blocks in more than a thousandth of
all places (fewer than a thousand of them) are named first and broadcast, so their
rows need not meet in one task.

Defined cases: null counts as the empty text. Of equal texts the largest doc_id stays;
rows that repeat it with the same text are one document and all carry the flag. A null
doc_id is smaller than any other. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh_name, hot_values, single_rows, stored, whole, with_digest

BLOCK = 16384


def named(df: DataFrame, *key: str) -> DataFrame:
    """Add ``name``: a long, equal for equal keys only, from a sort of the keys.

    Names of hot keys are negative, the others positive; zero stays free.
    """
    spread = df.withColumn("_hash", F.xxhash64(*key))
    hot, rows = hot_values(spread, "_hash", "names-hot")
    buckets = max(1024, rows // 1024)
    hot_keys = (
        spread.join(F.broadcast(hot), "_hash", "left_semi")
        .select(*(F.col(c).alias(f"_hot_{c}") for c in key))
        .distinct()
    )
    order = Window.orderBy(*hot_keys.columns)
    hot_names = stored(
        hot_keys.withColumn("_hot_name", -F.row_number().over(order).cast("long")), "names-often"
    )
    same = [F.col(c) == F.col(f"_hot_{c}") for c in key]
    cold = F.col("_hot_name").isNull()
    elsewhere = F.pmod(F.xxhash64(*(c for c in df.columns if c not in key)), F.lit(buckets))
    placed = spread.join(F.broadcast(hot_names), same, "left").withColumn(
        "_bucket",
        F.when(cold, F.pmod("_hash", F.lit(buckets))).otherwise(elsewhere + buckets),
    )
    for c in key:  # a named key need not travel
        placed = placed.withColumn(c, F.when(cold, F.col(c)))
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*key))
    name = F.coalesce("_hot_name", rank.cast("long") * buckets + F.col("_bucket"))
    return placed.select(*(c for c in df.columns if c not in key), name.alias("name"))


def identities(docs: DataFrame, block: int = BLOCK, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, text_sha256, and (level, name), the identity of its text.

    Columns to be ``carried`` are passed on too.
    """
    raw = whole("text").cast("binary")
    rows = docs.select(
        "doc_id",
        F.xxhash64(whole("text")).alias("tie"),  # tells rows that repeat a doc_id apart
        F.sha2(raw, 256).alias("text_sha256"),
        F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / block)).cast("int").alias("blocks"),
        raw.alias("raw"),
        *carried,
    )
    cut = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.substring(F.col("raw"), i * block + 1, F.lit(block)),
    )
    once = ("text_sha256", *carried)  # these travel with the first block only
    pieces = rows.select(
        "doc_id", "tie", "blocks", *once, F.posexplode(cut).alias("place", "block")
    )
    for c in once:
        pieces = pieces.withColumn(c, F.when(F.col("place") == 0, F.col(c)))
    level0 = stored(named(pieces, "block"), "names-blocks")

    finished, level = [], 0
    now = level0.where("blocks > 1").select("doc_id", "tie", "blocks", "place", "name")
    longest = now.agg(F.max("blocks")).first()[0] or 1
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        pairs = now.groupBy("doc_id", "tie", "blocks", F.floor(F.col("place") / 2).alias("at")).agg(
            F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(0)).alias(
                "right"
            ),
        )
        done = stored(named(stored(pairs, "names-pairs"), "left", "right"), f"names-{level}")
        ended = F.col("blocks") <= 2**level
        finished.append(done.where(ended).withColumn("level", F.lit(level)))
        now = done.where(~ended).withColumnRenamed("at", "place")

    first = level0.where("place = 0")
    result = first.where("blocks = 1").select(
        "doc_id", "text_sha256", F.lit(0).alias("level"), "name", *carried
    )
    for part in finished:
        part = part.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "level", "name")
        several = first.where("blocks > 1").drop("name")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
        result = result.unionByName(
            several.join(part, same).select("doc_id", "text_sha256", "level", "name", *carried)
        )
    return result


def exact_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    known = stored(identities(docs, block), "names-documents")
    groups = stored(
        known.groupBy(F.col("level").alias("_level"), F.col("name").alias("_name")).agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "names-groups",
    )
    same = (F.col("level") == F.col("_level")) & (F.col("name") == F.col("_name"))
    return known.join(groups, same).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per text.

    Rows that share an id, or have none, are judged one by one. Where rows repeat the largest
    doc_id with the same text, the one with the largest digest of all its columns stays.
    """
    kept, own = fresh_name(docs, "kept_row"), fresh_name(docs, "row_digest")
    rows = with_digest(docs, own)
    named_rows = rows.select("doc_id", "text", F.col(own).alias("_row"))
    stay = (
        stored(identities(named_rows, carried=("_row",)), "names-documents")
        .groupBy("level", "name")
        .agg(F.max(F.struct("doc_id", "_row")).alias("last"))
        .select(F.col("last._row").alias(kept))
    )
    stay = stored(stay, "names-kept")
    return (
        single_rows(rows, own)
        .join(stay, F.col(own) == F.col(kept), "left_semi")
        .select(*docs.columns)
    )
