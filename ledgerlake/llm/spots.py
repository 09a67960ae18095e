"""SpotSigs fingerprints with DataFrame functions only.

An anchor is a very common word; its signature is the anchor and the next two words that
are not common. In a stretch without anchors (no common word among four words) every word
is an anchor of the two words behind it, so lists, junk and foreign text have signatures
too. A fingerprint is the set of a text's signatures, as sorted hashes.

Two fingerprints are compared by their Jaccard similarity, pruned by set length: lengths
are divided into partitions of a factor 1 / FLOOR, and sets that are neither in the same
nor in neighbouring partitions, or whose lengths alone keep the similarity below FLOOR,
are not intersected; their likeness is 0.

``with_next`` brings each document together with the next one in descending doc_id
without sorting everything in one task: ids are cut into ranges, a window runs inside a
range, and the first document of a range is sent along as a guest of the range before.

Defined cases: a null text is empty. A text without letters or digits is split at white
space; one that is blank has the empty fingerprint. Two empty fingerprints are alike
(1), an empty and another are not (0). Rows that repeat a doc_id follow each other in the
order of a hash of their texts. A null doc_id comes last. A single document is its own
next one. An empty table gives no rows. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlake.llm.common import whole

# Very common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from has have he in is it its not of on or that the "
    "this to was were which with you "
    "auf aus bei das dem den der des die ein eine einer für im ist mit nicht sich sind "
    "und von zu zum zur "
    "au aux avec ce dans de du elle en est et il la le les ne pas par pour que qui se sur "
    "un une "
    "al como con del el es lo los las más no para por su una y"
).split()
STRETCH = 4
FLOOR = 0.05
ROWS_PER_RANGE = 1024
MOST_RANGES = 16384
STEP = 128  # cuts looked through at a time


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; without any, the parts between white space."""
    plain = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    parts = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.when(F.size(plain) > 0, plain).otherwise(parts)


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the sorted array of a text column's signature hashes."""

    def common(word):
        return word.isin(*ANCHORS)

    parts = df.withColumn("_words", words(F.col(text)))
    parts = parts.withColumn("_common", F.transform("_words", common))
    parts = parts.withColumn(
        "_anchors",
        F.filter(F.sequence(F.lit(0), F.size("_words")), lambda i: F.get("_common", i)),
    ).withColumn("_content", F.filter("_words", lambda w: ~common(w)))

    def chain(i, nth):  # nth anchors, so i - nth content words, stand before place i
        at = i - nth
        return F.xxhash64(
            F.get("_words", i), F.get("_content", at), F.get("_content", at + 1)
        )

    def stretch(i):
        alone = ~F.get("_common", i)
        for back in range(1, STRETCH):
            alone = alone & ~F.coalesce(F.get("_common", i - back), F.lit(False))
        return alone

    # a place before the text is no common word, so a text's first words are a stretch
    lone = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("_words") - 1, F.lit(0))),
        lambda i: (i < F.size("_words")) & stretch(i),
    )
    lone = F.transform(
        lone,
        lambda i: F.xxhash64(
            F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2), F.lit(1)
        ),
    )
    chained = F.transform("_anchors", chain)
    both = F.concat(chained, lone)
    return parts.withColumn(name, F.array_sort(F.array_distinct(both))).drop(
        "_words", "_common", "_anchors", "_content"
    )


def fingerprint(signatures: Column) -> Column:
    """The signatures' hashes as text, 16 hexadecimal digits each."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def partition(signatures: Column) -> Column:
    """The number of a set's length partition."""
    return F.floor(F.log(F.size(signatures).cast("double")) / F.log(F.lit(1 / FLOOR)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets, 0 where their lengths rule FLOOR out."""
    n, m = F.size(a), F.size(b)
    far = F.abs(partition(a) - partition(b)) > 1
    short = F.least(n, m) < F.lit(FLOOR) * F.greatest(n, m)
    both = F.size(F.array_intersect(a, b))
    return (
        F.when((n == 0) & (m == 0), 1.0)
        .when((n == 0) | (m == 0), 0.0)
        .when(far | short, 0.0)
        .otherwise(both / (n + m - both))
    )


def numbers(values) -> Column:
    """A constant array of doubles, sent as one text."""
    listed = ",".join(map(repr, values))
    return F.split(F.lit(listed), ",").cast("array<double>") if listed else F.array().cast("array<double>")


def with_next(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Add ``next_<column>`` from the row that follows in descending doc_id.

    After the last row comes the first. Ranges end at quantiles of doc_id, so that ids may lie
    anywhere; they are MOST_RANGES at most, so the table of
    their first rows is bounded and may be broadcast.
    """
    if isinstance(df.schema["doc_id"].dataType, StringType):  # the first bytes keep the order
        bytes6 = F.rpad(F.substring(F.hex("doc_id"), 1, 12), 12, "0")
        value = F.conv(bytes6, 16, 10).cast("double")
    else:
        value = F.col("doc_id").cast("double")  # may round, never turns two ids round
    count = df.count()
    ranges = min(MOST_RANGES, max(1, count // ROWS_PER_RANGE))
    if not count:
        return df.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    cuts = []
    if ranges > 1:
        parts = numbers(i / ranges for i in range(1, ranges))
        found = df.agg(F.percentile_approx(value, parts, 10 * ranges)).first()[0]
        cuts = sorted(set(found or []), reverse=True)
    # the highest ids are in range 0; null ids have the last range for themselves
    above = F.lit(0)
    if cuts:  # how many cuts lie above an id, found in two steps
        coarse = F.size(F.filter(numbers(cuts[STEP - 1 :: STEP]), lambda c: c > value))
        near = F.slice(numbers(cuts), coarse * STEP + 1, F.lit(STEP))
        above = coarse * STEP + F.size(F.filter(near, lambda c: c > value))
    place = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(above).cast("int")
    placed = df.withColumn("_range", place)
    ends = placed.groupBy("_range").agg(F.max("doc_id").alias("_head"))
    across = Window.orderBy("_range")  # MOST_RANGES rows
    first_to_last = F.max("_range").over(Window.partitionBy(F.lit(0)))
    guests = ends.select(
        F.col("_range").alias("_own"),
        "_head",
        F.coalesce(F.lag("_range").over(across), first_to_last).alias("_host"),
    )
    first = F.col("doc_id").eqNullSafe(F.col("_head"))
    sent = placed.join(F.broadcast(guests), F.col("_range") == F.col("_own"), "left")
    seats = F.when(
        first, F.array(F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest")),
                       F.struct(F.col("_host").alias("at"), F.lit(1).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest"))))
    sent = sent.withColumn("_seat", F.explode(seats)).drop("_range", "_own", "_head", "_host")
    along = Window.partitionBy("_seat.at").orderBy(
        F.col("_seat.guest"), F.col("doc_id").desc_nulls_last(), *order
    )
    following = [F.lead(c).over(along).alias(f"next_{c}") for c in columns]
    return sent.select("*", *following).where("_seat.guest = 0").drop("_seat")


def edited(text: Column, following: Column) -> Column:
    """A text whose last half is replaced by as much of the beginning of the next one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: the contract's columns of text, edited text and next document."""
    texts = docs.select("doc_id", whole("text").alias("text"))
    texts = with_signatures(texts, "text", "signatures").withColumn("_tie", F.xxhash64("text"))
    pairs = with_next(texts, ["text", "signatures"], ["_tie"])
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = pairs.drop("next_text", "_tie")
    pairs = with_signatures(pairs, "edited", "edited_signatures")
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )
