"""Near-duplicates by bottom-k sketches from one hash function.

Every word shingle is hashed once. A document's sketch retains its KEEP smallest values
(all of them if it has no more). Two documents that are similar enough share a known
number of retained values. Each brings the first few of its values, in an order that puts
common values last, into inverted lists: so many that two similar documents meet in
OVERLAP lists or more, where they share as many values at all. Documents that meet in fewer
are no pair: rare values shared by chance alone do not make one. The order comes from
counters of the retained values, MOST_COUNTERS at most; a wrong count costs time and loses
nothing. Lists are worked off in two rounds:

1. every document against one member of each of its lists;
2. pairs of list members that the links so far leave in different components.

A group of near-copies, however large, falls together in the first round, so its members
are never paired with each other. Variants of one text that are too far from each other to
be links do meet, all with all. So a member brings a code of 1,024 parities of its set to
its lists, and the join itself drops pairs whose codes differ in more places than the sets of a
link can: nothing is stored or shuffled for those. A pair is looked at if the sizes and
the codes allow the similarity, passes if the sketch of the union says so, and counts if
the full sets confirm it.

Sketches and sets are made from the texts wherever they are needed and never stored: they
are larger than the texts.

What is left to chance: for sets above KEEP (in the estimate ESTIMATE) values, a pair at
exactly the threshold is missed with a probability below 1e-7, for six standard deviations
are allowed for. The same holds for codes of sets above CODED values, which cover a sample;
codes of smaller sets lose nothing. Shingles are 64-bit hashes.

Defined cases: null and empty texts, and those without a word, have no shingles and are
linked with nothing. Texts of fewer words than a shingle are one shingle, the whole
sequence. Rows that share a doc_id are one document, linked if any of their texts is. A row
with a null doc_id is never linked and always kept. An empty table gives no rows. Other
columns than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    Scratch,
    fresh_name,
    python_workers,
    stored,
    whole,
    with_digest,
)
from ledgerlake.llm.components import components

WORDS = 5
PERCENT = 80
KEEP = 512
ESTIMATE = 128
OVERLAP = 4  # lists that two documents share before they are looked at
CODED = 1024  # values that a code covers at most; also its bits, 64 in a column
CODE = [f"code{i}" for i in range(CODED // 64)]
MOST_COUNTERS = 1 << 24
COUNTER_PART = 1 << 12
PART = 1 << 22  # bytes hashed at a time

_random = np.random.Generator(np.random.PCG64(20260101))
_LETTER = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_FACTORS = _random.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(which: int, count: int) -> np.ndarray:
    if len(_powers[which]) < count:
        size = max(count, 1 << 16)
        steps = np.full(size, _INVERSE if which else _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers[which] = np.cumprod(steps)
    return _powers[which][:count]


def word_values(data: bytes, space: np.ndarray = _SPACE) -> tuple[np.ndarray, ...]:
    """A hash, the start and the end of every word of a part, from sums over all its bytes."""
    letters = np.frombuffer(data, dtype=np.uint8)
    inside = ~space[letters]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[letters] * _power(0, len(letters)), out=sums[1:])
    words = (sums[ends] - sums[starts]) * _power(1, len(letters) + 1)[starts]
    return mixed(words + (ends - starts).astype(np.uint64) * _FACTORS[-1]), starts, ends


def word_hashes(text: str) -> np.ndarray:
    """A hash per word, A-Z read as a-z; words end at the six ASCII white-space characters."""
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= PART:
        return word_values(data)[0]
    parts, at = [], 0
    while at < len(data):  # cut behind the last white space, or take a longer word whole
        end = min(len(data), at + PART)
        while end < len(data) and not _SPACE[data[end - 1]]:
            end += 1
        parts.append(word_values(data[at:end])[0])
        at = end
    return np.concatenate(parts)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The hashes of a text's distinct shingles in ascending order."""
    hashes = word_hashes(text)
    size = min(words, len(hashes))
    if not size:
        return hashes
    total = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
    for i in range(size):
        total += hashes[i : i + len(total)] * _FACTORS[i]
    return np.unique(mixed(total + np.uint64(size)))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _texts(docs: DataFrame) -> DataFrame:
    python_workers(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), whole("text").alias("text"))


def code_level(n: int) -> int:
    """A code covers one in 2^level of a set's values, so that CODED are enough."""
    return max(0, (n - 1) // CODED).bit_length()


def parities(values: np.ndarray) -> bytes:
    """The code of an ascending set: whether 1,024 bins hold odd numbers of its values.

    Codes of two sets differ in no more places than the sets have values of their own. The
    first half is of the upper half of the values covered, the second of the lower, those
    that the next level covers; so the halves of a set, taken as one by exclusive or, meet
    the second half of a set one level below.
    """
    half = 1 << (63 - code_level(len(values)))
    ends = np.array([half - 1, 2 * half - 1], dtype=np.uint64)
    lower, covered = np.searchsorted(values, ends)
    bins = (values[:covered] % np.uint64(CODED // 2)).astype(np.int64)
    bins[:lower] += CODED // 2
    return np.packbits(np.bincount(bins, minlength=CODED) & 1).tobytes()


def digested(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, n (size of the set), high and low, a digest of it, and its code."""

    def read(batches):
        for batch in batches:
            sizes, digests, codes = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingle_set(text, words)
                sizes.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                codes.append(parities(values))
            digest = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            code = np.frombuffer(b"".join(codes), dtype="<i8").reshape(-1, len(CODE))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(np.ascontiguousarray(c)) for c in (*digest.T, *code.T)),
                ],
                names=["doc_id", "n", "high", "low", *CODE],
            )

    schema = "doc_id long, n long, high long, low long"
    return _texts(docs).mapInArrow(read, ", ".join([schema, *(f"{c} long" for c in CODE)]))


def _first_sketches(batches, words: int, keep: int):
    """(set size, digest, sketch) of every set a task has not met before."""
    seen = set()
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            values = shingle_set(text, words)
            digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
            if len(values) and digest not in seen:
                seen.add(digest)
                found.append((len(values), digest, values[:keep].view(np.int64)))
        yield found


def shared_least(n: int, percent: int, keep: int) -> int:
    """How many retained values a set of n shares at least with one that is similar enough."""
    exact = -(-percent * n // 100)
    if 100 * n <= percent * keep:  # a partner's sketch is its whole set as well
        return exact
    p = percent / 100
    return max(1, min(exact, math.floor(keep * p - 6 * math.sqrt(keep * p * (1 - p)))))


def counters_for(retained: int) -> int:
    """A power of two for about eight values a counter, up to MOST_COUNTERS."""
    return min(MOST_COUNTERS, 1 << max(16, (retained // 8).bit_length()))


def counted(docs: DataFrame, words: int, keep: int, size: int) -> np.ndarray:
    """How many retained values fall on each counter.

    A task sends one array of bytes per part of the counters that it met; the driver gets
    two bytes a counter. Higher counts stop at what fits: the order hardly needs them.
    """

    def count(batches):
        counts = np.zeros(size, dtype=np.uint32)
        for found in _first_sketches(batches, words, keep):
            if found:
                values = np.concatenate([sketch for _, _, sketch in found])
                counts += np.bincount(values % size, minlength=size).astype(np.uint32)
        parts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, COUNTER_PART)
        there = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(there), pa.array([parts[i].tobytes() for i in there], pa.binary())],
            names=["part", "counts"],
        )

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(COUNTER_PART, dtype=np.int64)
        for counts in group["counts"].to_pylist():
            total += np.frombuffer(counts, dtype=np.uint8)
        total = np.minimum(total, 65535).astype("<u2").tobytes()
        return pa.table({"part": group["part"][:1], "counts": pa.array([total], pa.binary())})

    found = (
        _texts(docs)
        .mapInArrow(count, "part long, counts binary")
        .groupBy("part")
        .applyInArrow(add, "part long, counts binary")
        .toArrow()
    )
    counts = np.zeros((size // COUNTER_PART, COUNTER_PART), dtype=np.uint16)
    for part, own in zip(found["part"].to_pylist(), found["counts"].to_pylist(), strict=True):
        counts[part] = np.frombuffer(own, dtype="<u2")
    return counts.ravel()


def bit_table(values: DataFrame, most: int = 1 << 24) -> np.ndarray:
    """Bits at the places of the values, of a size between 2^16 and ``most``.

    Rows off its places cannot be among the values; those on them are checked by a join.
    """
    count = values.count()
    size = min(most, max(1 << 16, 1 << (16 * count).bit_length()))
    place = F.pmod("value", F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    found = (
        values.select(F.floor(place / 64).alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(size // 64, dtype=np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def index_rows(
    docs: DataFrame,
    words: int,
    counts: np.ndarray,
    percent: int,
    keep: int,
    only: np.ndarray | None = None,
) -> DataFrame:
    """The first values of each sketch: value, high, low, place, n and least.

    ``least`` values are shared with any set that is similar enough. Of those, all but the
    last ``least`` - OVERLAP lie among the first values of both.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counts, only))

    def read(batches):
        counters, wanted = shared.value
        for found in _first_sketches(batches, words, keep):
            values, places, lengths, leasts = [], [], [], []
            for n, _, own in found:
                order = np.lexsort((own, counters[own % len(counters)]))
                least = shared_least(n, percent, keep)
                first = own[order[: len(own) - least + min(OVERLAP, least)]]
                leasts.append(least)
                at = np.arange(len(first), dtype=np.int32)
                if wanted is not None:
                    good = wanted[first % len(wanted)]
                    first, at = first[good], at[good]
                values.append(first)
                places.append(at)
                lengths.append(len(first))
            if not found:
                continue
            parts = np.frombuffer(b"".join(d for _, d, _ in found), dtype="<i8").reshape(-1, 2)
            sizes = np.array([n for n, _, _ in found], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(values)),
                    *(pa.array(np.repeat(c, lengths)) for c in (parts[:, 0], parts[:, 1])),
                    pa.array(np.concatenate(places)),
                    pa.array(np.repeat(sizes, lengths)),
                    pa.array(np.repeat(np.array(leasts, dtype=np.int32), lengths)),
                ],
                names=["value", "high", "low", "place", "n", "least"],
            )

    return _texts(docs).mapInArrow(
        read, "value long, high long, low long, place int, n long, least int"
    )


def inverted_lists(
    docs: DataFrame,
    first_ids: DataFrame,
    words: int,
    percent: int,
    keep: int,
    retained: int,
    scratch: Scratch,
) -> DataFrame:
    """(value, doc, place, n, least) for the values that two or more different sets retain."""
    counts = counted(docs, words, keep, counters_for(retained))
    several = scratch.stored(
        index_rows(docs, words, counts, percent, keep)
        .groupBy("value")
        .agg(F.min("high").alias("lowest"), F.max("high").alias("highest"))
        .where("lowest <> highest")
        .select("value"),
        "minhash-values",
    )
    rows = index_rows(docs, words, counts, percent, keep, bit_table(several))
    return scratch.stored(
        rows.join(several, "value")
        .join(first_ids, ["high", "low"])
        .select("value", F.col("first_id").alias("doc"), "place", "n", "least")
        .distinct(),
        "minhash-lists",
    )


def similar_sizes(percent: int):
    return 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")


def needed():
    """How many lists a pair x, y must share."""
    return F.least("x.least", "y.least", F.lit(OVERLAP))


def level_of(n: str):
    """``code_level`` of a column."""
    more = F.floor((F.col(n) - 1) / CODED)
    return F.when(more > 0, F.length(F.bin(more))).otherwise(0)


def codes_allow(percent: int):
    """Can x and y be similar enough, as far as their codes tell?

    The sets of a link have few values of their own, and a sample of these is no larger but
    for six standard deviations. A code that is missing, or of too far a level, tells nothing.
    """

    def differing(x: list, y: list):
        return sum(
            (F.bit_count(a.bitwiseXOR(b)) for a, b in zip(x[1:], y[1:], strict=True)),
            F.bit_count(x[0].bitwiseXOR(y[0])),
        )

    x, y = ([F.col(f"{side}.{c}") for c in CODE] for side in "xy")
    half = len(CODE) // 2
    x_next, y_next = (
        [a.bitwiseXOR(b) for a, b in zip(c[:half], c[half:], strict=True)] for c in (x, y)
    )
    above = F.col("x.level") - F.col("y.level")
    found = (
        F.when(above == 0, differing(x, y))
        .when(above == 1, differing(x_next, y[half:]))
        .when(above == -1, differing(x[half:], y_next))
    )
    own = F.floor((100 - percent) * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    share = F.pow(F.lit(0.5), F.greatest("x.level", "y.level"))
    return F.coalesce(found <= own * share + 6 * F.sqrt(own * share * (1 - share)), F.lit(True))


def shared_enough(met: DataFrame, of_needed) -> DataFrame:
    """The pairs that met in as many lists as they must share."""
    pairs = met.select(
        F.least("x.doc", "y.doc").alias("a"),
        F.greatest("x.doc", "y.doc").alias("b"),
        needed().alias("needed"),
    )
    counts = pairs.groupBy("a", "b").agg(
        F.count("*").alias("shared"), of_needed("needed").alias("needed")
    )
    return counts.where("shared >= needed").select("a", "b")


def first_round(lists: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Each document with one member of each of its lists, where enough lists agree.

    Others are left for the second round.
    """
    hubs = scratch.stored(
        lists.groupBy("value")
        .agg(F.min(F.struct("place", "doc", "n", "least")).alias("hub"))
        .select("value", "hub.*"),
        "minhash-hubs",
    )
    met = lists.alias("x").join(
        hubs.alias("y"),
        (F.col("x.value") == F.col("y.value"))
        & similar_sizes(percent)
        & (F.col("x.doc") != F.col("y.doc")),
    )
    return shared_enough(met, F.max)


def second_round(
    lists: DataFrame, grouped: DataFrame, known: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Pairs of list members in different components that share enough lists, once each.

    Of a list's largest component, members are paired with others only. An id with
    several sets has no code.
    """
    owned = scratch.stored(
        lists.join(grouped, F.col("doc") == F.col("node"), "left").select(
            "value", "doc", "n", "least", F.coalesce("component", "doc").alias("component")
        ),
        "minhash-owned",
    )
    open_lists = scratch.stored(
        owned.groupBy("value", "component")
        .count()
        .groupBy("value")
        .agg(
            F.count("*").alias("components"),
            F.max(F.struct("count", "component")).alias("largest"),
        )
        .where("components > 1")
        .select(F.col("value").alias("open_value"), F.col("largest.component").alias("largest")),
        "minhash-open",
    )
    single = (F.min("high") == F.max("high")) & (F.min("low") == F.max("low"))
    codes = known.groupBy(F.col("doc_id").alias("coded")).agg(
        *(F.when(single, F.min(c)).alias(c) for c in CODE)
    )
    member = (
        owned.join(open_lists, F.col("value") == F.col("open_value"))
        .groupBy("doc", "n", "least", "component")
        .agg(F.collect_list(F.struct("value", "largest")).alias("own"))
        .where(F.size("own") >= F.least("least", F.lit(OVERLAP)))  # fewer complete nothing
        .join(codes, F.col("doc") == F.col("coded"))
        .withColumn("level", level_of("n"))
        .select("doc", "n", "least", "component", "level", *CODE, F.explode("own").alias("at"))
        .select("*", "at.*")
        .drop("at")
    )
    member = scratch.stored(member, "minhash-members")
    x, y = member.where("component <> largest").alias("x"), member.alias("y")
    once = (F.col("y.component") == F.col("y.largest")) | (F.col("x.doc") < F.col("y.doc"))
    met = x.join(
        y,
        (F.col("x.value") == F.col("y.value"))
        & (F.col("x.component") != F.col("y.component"))
        & once
        & similar_sizes(percent)
        & codes_allow(percent),
    )
    return shared_enough(met, F.min)


def estimated(a: np.ndarray, b: np.ndarray, keep: int) -> float:
    """Similarity by the sketch of the union: the share of its values that both retain."""
    a, b = a[:keep], b[:keep]
    union = np.union1d(a, b)[:keep]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def brought_together(
    docs: DataFrame, pairs: DataFrame, words: int, most: int | None
) -> DataFrame:
    """Per pair (a, b) its ends: side, set size, and the set or its smallest values.

    A table of bits lets a task make the sets of documents in question only.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("value")).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(stored(wanted, "minhash-wanted")))

    def sets(batches):
        bits = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            rows = pa.array(np.flatnonzero(bits[ids % len(bits)]))
            texts = batch.column("text").take(rows).to_pylist()
            whole_sets = [shingle_set(text, words) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    pa.array([len(x) for x in whole_sets], pa.int64()),
                    _lists([x[:most] for x in whole_sets]),
                ],
                names=["doc_id", "n", "values"],
            )

    known = (
        _texts(docs)
        .where(F.col("doc_id").isNotNull())
        .mapInArrow(sets, "doc_id long, n long, values array<long>")
    )
    ends = pairs.select(
        "a", "b", F.posexplode(F.array("a", "b")).alias("side", "end")
    )
    end = F.struct("side", "n", "values")
    return (
        known.join(ends, F.col("doc_id") == F.col("end"))
        .groupBy("a", "b")
        .agg(F.collect_list(end).alias("ends"))
    )


def matching(together: DataFrame, good) -> DataFrame:
    """The pairs for which ``good(set size, values, set size, values)`` holds."""

    def check(batches):
        for batch in batches:
            ends = batch.column("ends")
            entries = ends.flatten()
            sides, sizes = (entries.field(k).to_numpy(zero_copy_only=False) for k in ("side", "n"))
            values = entries.field("values")
            starts = values.offsets.to_numpy()
            flat = values.values.to_numpy(zero_copy_only=False).view(np.uint64)
            bounds = np.concatenate([[0], np.cumsum(ends.value_lengths())])
            kept = []
            for i in range(batch.num_rows):
                sets = ([], [])
                for j in range(bounds[i], bounds[i + 1]):
                    sets[sides[j]].append((sizes[j], flat[starts[j] : starts[j + 1]]))
                kept.append(any(good(n, x, m, y) for n, x in sets[0] for m, y in sets[1]))
            rows = pa.array(np.flatnonzero(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(rows) for c in ("a", "b")], names=["a", "b"]
            )

    return together.mapInArrow(check, "a long, b long")


def confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that are links: likely by the sketch of the union, certain by the full sets."""
    p = percent / 100
    least = p - 6 * math.sqrt(p * (1 - p) / ESTIMATE)

    def likely(n, x, m, y):
        if 100 * min(n, m) < percent * max(n, m):
            return False
        return estimated(x, y, ESTIMATE) >= (least if max(n, m) > ESTIMATE else p - 1e-9)

    def certain(n, x, m, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    near = stored(
        matching(brought_together(docs, pairs, words, ESTIMATE), likely), "minhash-likely"
    )
    return stored(matching(brought_together(docs, near, words, None), certain), "minhash-links")


def near_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, keep: int = KEEP
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    known = stored(digested(docs, words), "minhash-digests")
    usable = known.where("n > 0 and doc_id is not null")
    first_ids = stored(
        usable.groupBy("high", "low").agg(F.min("doc_id").alias("first_id")), "minhash-first"
    )
    retained = usable.agg(F.sum(F.least("n", F.lit(keep)))).first()[0] or 0
    scratch = Scratch(docs.sparkSession)
    lists = inverted_lists(docs, first_ids, words, percent, keep, retained, scratch)
    tried = stored(first_round(lists, percent, scratch), "minhash-first-pairs")
    links = confirmed(docs, tried, words, percent)
    rest = second_round(lists, components(links), usable, percent, scratch).join(
        tried, ["a", "b"], "left_anti"
    )
    rest = stored(rest, "minhash-second-pairs")
    scratch.give_up()
    links = links.union(confirmed(docs, rest, words, percent))
    # rows that share a doc_id are one document, whatever their texts
    same_id = (
        usable.join(first_ids, ["high", "low"])
        .where("doc_id <> first_id")
        .select("doc_id", "first_id")
    )
    repeated = usable.groupBy("doc_id").agg(
        F.min("high").alias("least"), F.max("high").alias("most")
    )
    repeated = stored(repeated.where("least <> most").select("doc_id"), "minhash-repeated")
    if not repeated.isEmpty():
        links = links.union(same_id.join(repeated, "doc_id").toDF("a", "b"))
    grouped = components(links)
    named = stored(
        first_ids.join(grouped, F.col("first_id") == F.col("node"), "left").select(
            F.col("high").alias("set_high"),
            F.col("low").alias("set_low"),
            F.coalesce("component", "first_id").alias("component"),
        ),
        "minhash-named",
    )
    same = (F.col("high") == F.col("set_high")) & (F.col("low") == F.col("set_low"))
    linked = known.join(named, same & (F.col("n") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return linked.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def without_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Rows are judged one by one: each gets a number of its own first, so that rows which
    share an id, or have none, are linked by their own texts. Of a group the row with the
    smallest doc_id stays, one without an id last; ties go by a digest of the row.
    """
    row, digest = fresh_name(docs, "row_number"), fresh_name(docs, "row_digest")
    numbered = with_digest(docs, digest).withColumn(row, F.monotonically_increasing_id())
    rows = stored(numbered, "minhash-rows")  # the numbers are fixed from here on
    groups = near_groups(rows.select(F.col(row).alias("doc_id"), "text"), words, percent)
    place = rows.select(F.col(row).alias("of_row"), F.col("doc_id").alias("id"), digest)
    groups = stored(
        groups.where("n_shingles > 0").select(F.col("doc_id").alias("member"), "component_id"),
        "minhash-groups",
    )
    several = groups.groupBy("component_id").count().where("count > 1").select("component_id")
    linked = stored(groups.join(several, "component_id"), "minhash-linked")
    order = F.struct(F.col("id").isNull(), "id", digest, "member")
    stays = (
        linked.join(place, F.col("member") == F.col("of_row"))
        .groupBy("component_id")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.member").alias("member"))
    )
    gone_row = fresh_name(rows, "gone_row")
    gone = linked.join(stays, "member", "left_anti").select(F.col("member").alias(gone_row))
    return rows.join(gone, F.col(row) == F.col(gone_row), "left_anti").drop(row, digest)
