"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / source_size times. Its source's
documents stand in a fixed order, the expected copies are summed along it, one random
offset per source is added, and a document is emitted once for each whole number that
its step crosses. Documents of like size stand together, and of DRAWS random offsets a
source takes the one whose words come nearest to its target, so the words taken follow
the target closely although whole documents are taken.

Ranks come in two steps: a source is cut into cells (size class, salt), counts per
cell are summed along the source, and rows are numbered inside their cell only. A
source with a third of all rows is thus spread over many tasks.

Defined cases: a null text has size 0. Sources of size 0 take nothing. A null source is
a source of its own, the last. Rows that repeat a doc_id are separate documents. An empty
table gives no rows. Columns beyond doc_id, text and source are not looked at by ``plan``
and kept as they are by ``emit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, fresh_name, single_rows, stored, whole, with_digest

MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
SALTS = 32
DRAWS = 16
SEED = 7


def source_targets(
    sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """(source, source_size, target): shares of all sizes by weight, capped and reshared.

    Weights repeat over the sources by code point, null last. One row per source is
    sorted in one task: a mix names its sources, so there are few. Each round finds
    the level that shares what the capped sources leave; a capped source stays capped,
    so the rounds end.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    sources = stored(
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.array(*map(F.lit, weights))[place].cast("double")),
        "mix-sources",
    )
    cap = F.col("source_size") * float(max_repeat)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > cap
        full, free, count = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1)),
        ).first()
        if count == capped or free == 0:
            break
        capped, level = count, (total - max_repeat * full) / free
    if level is None:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    target = F.least(cap, F.col("weight") * level)
    return sources.select("source", "source_size", target.alias("target"))


def source_offset(source, seed: int, draw: int):
    """One number in [0, 1) per source and draw, the same in every run."""
    name = F.coalesce(F.concat(F.lit("+"), source), F.lit("-"))
    digest = F.md5(F.concat(F.lit(f"{seed}:{draw}:"), name))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)


def plan(
    docs: DataFrame,
    seed: int = SEED,
    weights=WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target and copies.

    Columns to be ``carried`` are passed on too, and order rows that are alike in size and id.
    """
    sized = docs.select(
        "doc_id",
        "source",
        F.regexp_count(whole("text"), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f":{seed}"))).alias("mark"),
        *carried,
    )
    sized = stored(
        sized.select(
            "doc_id",
            "source",
            "size",
            F.coalesce("mark", F.lit("")).alias("mark"),
            F.length(F.bin("size")).alias("size_class"),
            *carried,
        ).withColumn(
            "salt", (F.conv(F.substring(F.col("mark"), 1, 7), 16, 10).cast("long") % SALTS)
        ),
        "mix-sizes",
    )
    sized = sized.withColumn("salt", F.coalesce("salt", F.lit(0)))
    targets = stored(source_targets(sized, weights, max_repeat), "mix-targets")
    along = Window.partitionBy("source").orderBy("size_class", "salt")
    cells = (
        sized.groupBy("source", "size_class", "salt")
        .count()
        .withColumn("before", F.sum("count").over(along) - F.col("count"))
        .withColumnRenamed("source", "cell_source")
        .join(targets, F.col("cell_source").eqNullSafe(F.col("source")))
        .select(
            "cell_source",
            F.col("size_class").alias("cell_class"),
            F.col("salt").alias("cell_salt"),
            "before",
            "source_size",
            "target",
        )
    )
    cells = stored(cells, "mix-cells")
    inside = Window.partitionBy("source", "size_class", "salt").orderBy(
        "size", "mark", "doc_id", *carried
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ranked = sized.withColumn("place", F.row_number().over(inside)).join(
        cells,
        F.col("source").eqNullSafe(F.col("cell_source"))
        & (F.col("size_class") == F.col("cell_class"))
        & (F.col("salt") == F.col("cell_salt")),
    )
    ranked = stored(
        ranked.select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            rate.alias("rate"),
            (F.col("before") + F.col("place")).alias("rank"),
            *carried,
        ),
        "mix-ranks",
    )

    def copies(start):
        step = F.floor(F.col("rate") * F.col("rank") + start)
        return step - F.floor(F.col("rate") * (F.col("rank") - 1) + start)

    starts = [source_offset(F.col("source"), seed, d) for d in range(DRAWS)]
    sums = [F.sum(F.col("size") * copies(start)) for start in starts]
    drawn = ranked.groupBy("source").agg(
        *(F.abs(s - F.first("target")).alias(f"off{d}") for d, s in enumerate(sums))
    )
    nearest = F.array_min(
        F.array(*(F.struct(F.col(f"off{d}").alias("off"), F.lit(d).alias("draw")) for d in range(DRAWS)))
    )
    starts = [source_offset(F.col("of_source"), seed, d) for d in range(DRAWS)]
    drawn = stored(
        drawn.select(F.col("source").alias("of_source"), nearest["draw"].alias("draw")).select(
            "of_source", F.get(F.array(*starts), F.col("draw")).alias("start")
        ),
        "mix-draws",
    )
    return ranked.join(drawn, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies(F.col("start")).cast("long").alias("copies"),
        *carried,
    )


def emit(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan says, with all its columns.

    Rows that share a doc_id, or have none, get the copies of their own place. Rows alike in
    every column cannot be told apart: one of them is emitted as often as all of them together.
    """
    own, of_row, copies, copy = (
        fresh_name(docs, n) for n in ("row_digest", "of_row", "copies", "copy")
    )
    rows = with_digest(docs, own)
    planned = rows.select("doc_id", "text", "source", F.col(own).alias("_row"))
    chosen = (
        plan(planned, **settings, carried=("_row",))
        .groupBy(F.col("_row").alias(of_row))
        .agg(F.sum("copies").alias(copies))
        .where(F.col(copies) > 0)
    )
    return (
        single_rows(rows, own)
        .join(chosen, F.col(own) == F.col(of_row))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(*docs.columns)
    )


def oracle() -> str:
    """The plan's words per document as SQL: levels in closed form, ranks without cells."""
    return f"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   md5(doc_id || ':{SEED}') AS mark
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ((row_number() OVER (ORDER BY source NULLS LAST) - 1)
                    % {len(WEIGHTS)} + 1)::DOUBLE AS weight
            FROM sized GROUP BY source
        ), ordered AS (
            SELECT *, row_number() OVER (
                ORDER BY {MAX_REPEAT}.0 * source_size / weight, source NULLS LAST) AS k
            FROM sources
        ), levels AS (
            SELECT *, ((SELECT sum(source_size)::BIGINT FROM sources) - {MAX_REPEAT} * coalesce(
                sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
                    AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
                / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW
                    AND UNBOUNDED FOLLOWING) AS level
            FROM ordered
        ), targets AS (
            SELECT source, source_size, least({MAX_REPEAT}.0::DOUBLE * source_size, weight * (
                SELECT arg_min(level, k) FROM levels
                WHERE level * weight <= {MAX_REPEAT}.0::DOUBLE * source_size)) AS target
            FROM sources
        ), ranked AS (
            SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
                   CASE WHEN t.source_size > 0 THEN t.target / t.source_size
                        ELSE 0.0::DOUBLE END AS rate,
                   row_number() OVER (PARTITION BY s.source ORDER BY length(bin(s.size)),
                       ('0x' || substr(s.mark, 1, 7))::BIGINT % {SALTS}, s.size, s.mark, s.doc_id
                   ) AS rank
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), starts AS (
            SELECT source, draw, ('0x' || substr(md5('{SEED}:' || draw || ':'
                       || coalesce('+' || source, '-')), 1, 12))::BIGINT::DOUBLE
                       / 281474976710656.0::DOUBLE AS start
            FROM sources, range({DRAWS}) r(draw)
        ), drawn AS (
            SELECT r.source, s.draw, s.start, any_value(r.target) AS target,
                   sum(r.size * (floor(r.rate * r.rank + s.start)
                       - floor(r.rate * (r.rank - 1) + s.start))) AS taken
            FROM ranked r JOIN starts s ON r.source IS NOT DISTINCT FROM s.source
            GROUP BY ALL
        ), chosen AS (
            SELECT source, arg_min(start, (abs(taken - target), draw)) AS start
            FROM drawn GROUP BY source
        )
        SELECT r.doc_id, r.size, r.source_size, r.target,
               (r.size * (floor(r.rate * r.rank + c.start)
                   - floor(r.rate * (r.rank - 1) + c.start)))::BIGINT AS taken
        FROM ranked r JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source
    """
