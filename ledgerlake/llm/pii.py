"""Personal data by bootstrapped contextual extraction.

Four rules find base entities. They are the seeds: the one to three words before a seed
are lexical patterns. Places that look like an identifier but that no rule takes
(a number of seven digits or more, an address written with (at), groups of hex digits)
are candidates; what they name is an instance, however it is punctuated, so that a
number known from a seed is known in any other spelling.

Patterns and instances form a graph, which Spark scores in rounds:

- a pattern's confidence for a kind is the share of its occurrences in all texts that
  known instances of the kind follow, with one occurrence against it; candidates that
  would fit the kind, but are not known, count UNKNOWN of an occurrence. A pattern with
  MIN_SUPPORT different known instances and MIN_CONFIDENCE or more takes part;
- an instance's score for a kind is one minus the product of one minus confidence over
  the different patterns of one length before it, the best of the lengths. From ACCEPT on
  the instance is known, and supports patterns in the next round.

Rounds end when nothing new is known, after MOST_ROUNDS at the latest (a documented
limit). Candidates that name a known instance are added to the spans, as kinds of their
own behind the base kinds; base spans stay as they are.

Of several places behind the same word the first one counts as following it, so that a
pattern has no more followers than occurrences. Words end at white space and at the signs in SEPARATORS, with A-Z read as a-z. Words,
patterns and instances are 64-bit hashes.

Defined cases: a null or empty text has no spans. Text is all that decides, so equal
texts have equal spans, and copies of a text add occurrences on both sides of a
pattern's share but never support. Rows that share or lack a doc_id are answered one by
one. An empty table gives no rows. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import python_workers, stored, whole
from ledgerlake.llm.minhash import bit_table, mixed, word_values

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.6
ACCEPT = 0.8
UNKNOWN = 0.25
MOST_ROUNDS = 8
LONGEST = 3  # words of a pattern
PARTS = 16  # a pattern's edges are spread over so many keys
SEPARATORS = b" \t\n\x0b\x0c\r:;=<>()[]{}\"'`,|*#"

# The base rules.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Candidates: what an identifier looks like beside the rules.
_NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9](?:[\x20().\-/]{0,2}[0-9])++")
_AT = re.compile(r"\x20?[(\[{]at[)\]}]\x20?", re.ASCII | re.IGNORECASE)
_DOTTED = re.compile(
    r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]+)+", re.ASCII | re.IGNORECASE
)
_DOT = re.compile(r"\x20?[(\[{]dot[)\]}]\x20?", re.ASCII | re.IGNORECASE)
_GROUPS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::{1,2}[0-9A-Fa-f]{1,4}+){3,7}+")
_DIGIT = re.compile(r"[0-9]+")

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[list(SEPARATORS)] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)
PART = 1 << 22  # bytes hashed at a time


def digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def passes_luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] in _LOCAL:
        at -= 1
    return at


def emails(text: str) -> list[tuple[int, int]]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = _local_start(text, at, last)
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            found.append((start, last))
        else:
            last = at + 1
        at = text.find("@", last)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; failing matches use up their place."""
    found = [(0, a, b) for a, b in emails(text)]
    for match in _IP.finditer(text):
        parts = match.group().split(".")
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in parts):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        number = digits(match.group())
        if 13 <= len(number) <= 19 and passes_luhn(number):
            found.append((2, *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= len(digits(match.group())) <= 15:
            found.append((3, *match.span()))
    return found


def name_of(kind: str, value: str) -> int:
    digest = hashlib.blake2b(f"{kind}:{value}".encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(digest.digest(), "little", signed=True)


def base_name(kind: int, value: str) -> int:
    """The instance a base span names: numbers by their digits, others without case."""
    return name_of("number", digits(value)) if kind > 1 else name_of(KINDS[kind], value.lower())


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(fits, start, end, instance); bit k of ``fits`` says that kind k is possible."""
    found = []
    for match in _NUMBER.finditer(text):
        number = digits(match.group())
        fits = (12 <= len(number) <= 19) << 2 | (7 <= len(number) <= 15) << 3
        a, b = match.span()
        if fits and not (b < len(text) and text[b].isascii() and text[b].isalnum()):
            found.append((fits, a, b, name_of("number", number)))
    last = 0
    for match in _AT.finditer(text) if "(" in text or "[" in text or "{" in text else ():
        start = _local_start(text, match.start(), last)
        domain = _DOTTED.match(text, match.end()) if start < match.start() else None
        last = match.end()
        if domain:
            address = text[start : match.start()] + "@" + _DOT.sub(".", domain.group())
            last = domain.end()
            found.append((1, start, last, name_of("email", address.lower())))
    for match in _GROUPS.finditer(text) if ":" in text else ():
        found.append((2, *match.span(), name_of("ip", match.group().lower())))
    return found


def apart(found, taken):
    """The candidates, by start, that overlap neither a base span nor one before."""
    starts, ends = [], []  # of the base spans' union
    for a, b in sorted((a, b) for _, a, b in taken):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    kept, last = [], 0
    for one in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        i = bisect_left(starts, one[2]) - 1
        if one[1] >= last and (i < 0 or ends[i] <= one[1]):
            kept.append(one)
            last = one[2]
    return kept


def words_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the end, in bytes, of every word."""
    data = text.encode("utf-8", "surrogatepass").lower()
    values, ends, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PART)
        while end < len(data) and not _SEPARATOR[data[end - 1]]:
            end += 1
        own, _, own_ends = word_values(data[at:end], _SEPARATOR)
        values.append(own)
        ends.append(own_ends + at)
        at = end
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(values), np.concatenate(ends)


def patterns_of(values: np.ndarray) -> list[np.ndarray]:
    """Per length from 1 to LONGEST: the pattern that ends at each word, from the first."""
    out, total = [], np.zeros(len(values), dtype=np.uint64)
    for length in range(1, LONGEST + 1):
        total = total[: max(0, len(values) - length + 1)] * _STEP + values[length - 1 :]
        out.append(mixed(total + np.uint64(length)).view(np.int64))
    return out


_MENTION = pa.struct(
    [
        ("kind", pa.int32()),
        ("fits", pa.int32()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("instance", pa.int64()),
        ("before", pa.list_(pa.int64())),
    ]
)


def mentions_of(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and candidates with the patterns before them, shortest first."""
    found = [(k, 0, a, b, base_name(k, text[a:b])) for k, a, b in base]
    found += [(-1, *c) for c in apart(candidates(text), base)]
    if not found:
        return []
    values, ends = words_of(text)
    patterns = patterns_of(values)
    starts = np.array([m[2] for m in found])
    if not text.isascii():
        order = np.argsort(starts, kind="stable")
        at = before = 0
        places = np.zeros(len(found), dtype=np.int64)
        for i in order:
            before += len(text[at : starts[i]].encode("utf-8", "surrogatepass"))
            at = places[i] = starts[i]
            places[i] = before
        starts = places
    ended = np.searchsorted(ends, starts, "right").tolist()
    first = {}
    for i in sorted(range(len(found)), key=lambda i: (found[i][2], i)):
        first.setdefault(ended[i], i)
    return [
        {
            "kind": kind,
            "fits": fits,
            "start": a,
            "end": b,
            "instance": instance,
            "before": [
                int(patterns[n - 1][w - n])
                for n in range(1, LONGEST + 1)
                if w >= n and first[w] == i
            ],
        }
        for i, ((kind, fits, a, b, instance), w) in enumerate(zip(found, ended, strict=True))
    ]


def scanned(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, high and low (digest of the text), base spans and mentions."""
    python_workers(docs.sparkSession)
    spans = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for batch in batches:
            high, low, base, mentions = [], [], [], []
            for text in batch.column("text").to_pylist():
                data = text.encode("utf-8", "surrogatepass")
                digest = hashlib.blake2b(data, digest_size=16).digest()
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                found = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                mentions.append(mentions_of(text, found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(base, spans),
                    pa.array(mentions, pa.list_(_MENTION)),
                ],
                names=["doc_id", "high", "low", "base", "mentions"],
            )

    return docs.select(F.col("doc_id").cast("long"), whole("text").alias("text")).mapInArrow(
        scan,
        "doc_id long, high long, low long, base array<struct<kind:int,start:long,end:long>>, "
        "mentions array<struct<kind:int,fits:int,start:long,end:long,instance:long,"
        "before:array<long>>>",
    )


def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, occurrences): how often each of the patterns stands in all texts.

    A task counts what its bits let through and returns each pattern once.
    """
    python_workers(docs.sparkSession)
    table = bit_table(patterns.select(F.col("pattern").alias("value")))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches):
        bits, total = shared.value, Counter()
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                for own in patterns_of(words_of(text)[0]):
                    found.append(own[bits[own % len(bits)]])
            if found:
                values, times = np.unique(np.concatenate(found), return_counts=True)
                total.update(dict(zip(values.tolist(), times.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
            names=["seen", "times"],
        )

    counted = (
        docs.select(whole("text").alias("text"))
        .mapInArrow(count, "seen long, times long")
        .groupBy("seen")
        .agg(F.sum("times").alias("occurrences"))
    )
    return counted.join(patterns, F.col("seen") == F.col("pattern")).select(
        "pattern", "occurrences"
    )


def graph(scans: DataFrame) -> DataFrame:
    """Edges (pattern, length, instance, fits, times), one per pattern and instance."""
    return (
        scans.select(F.explode("mentions").alias("m"))
        .select("m.instance", "m.fits", F.posexplode("m.before").alias("length", "pattern"))
        .groupBy("pattern", "instance")
        .agg(
            F.first("length").alias("length"),
            F.bit_or("fits").alias("fits"),
            F.count("*").alias("times"),
        )
    )


def by_pattern(edges: DataFrame, patterns: DataFrame, how: str = "inner") -> DataFrame:
    """A join on the pattern whose edges, however many, lie on PARTS keys."""
    part = F.pmod(F.xxhash64("instance"), F.lit(PARTS)).cast("int")
    spread = patterns.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return edges.withColumn("part", part).join(spread, ["pattern", "part"], how).drop("part")


def kind_sums(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Per pattern: times in all, and per kind times and instances known, times that may be."""
    own = known.select(F.col("instance").alias("known_instance"), F.col("kind").alias("own"))
    met = edges.join(own, F.col("instance") == F.col("known_instance"), "left")
    sums = [F.sum("times").alias("times")]
    for k in range(len(KINDS)):
        is_kind = F.col("own") == k
        may = F.col("own").isNull() & (F.col("fits").bitwiseAND(F.lit(1 << k)) > 0)
        sums += [
            F.sum(F.when(is_kind, F.col("times")).otherwise(0)).alias(f"followed{k}"),
            F.count(F.when(is_kind, 1)).alias(f"support{k}"),
            F.sum(F.when(may, F.col("times")).otherwise(0)).alias(f"unknown{k}"),
            F.count(F.when(may, 1)).alias(f"hopes{k}"),
        ]
    return met.groupBy("pattern").agg(*sums)


def possible_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """The patterns that can ever take part, were every candidate that fits a kind known.

    A pattern occurs at least as often as something follows it, so its confidence stays
    below that share. Words of no particular meaning precede all kinds and end here,
    before their occurrences are counted.
    """
    may = F.lit(False)
    for k in range(len(KINDS)):
        share = (F.col(f"followed{k}") + F.col(f"unknown{k}")) / (F.col("times") + 1)
        enough = F.col(f"support{k}") + F.col(f"hopes{k}") >= MIN_SUPPORT
        may = may | (enough & (share >= MIN_CONFIDENCE))
    return kind_sums(edges, known).where(may).select("pattern")


def scored_patterns(edges: DataFrame, known: DataFrame, counts: DataFrame) -> DataFrame:
    """(pattern, kind, confidence, support) of the patterns that take part."""
    summed = kind_sums(edges, known).join(counts, "pattern")
    kinds = [
        F.struct(
            F.lit(k).alias("kind"),
            F.col(f"support{k}").alias("support"),
            F.least(
                F.lit(0.99),
                F.col(f"followed{k}")
                / (F.col("occurrences") - (1 - UNKNOWN) * F.col(f"unknown{k}") + 1),
            ).alias("confidence"),
        )
        for k in range(len(KINDS))
    ]
    return (
        summed.select("pattern", F.inline(F.array(*kinds)))
        .where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
        .select("pattern", "kind", "confidence", "support")
    )


def scored_instances(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """(instance, kind, score) of the candidates behind patterns that take part.

    A candidate that fits several kinds gets the one it scores best in.
    """
    fits = F.col("fits").bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("kind"))) > 0
    of_length = (
        by_pattern(edges.where("fits > 0"), patterns)
        .where(fits)
        .groupBy("instance", "kind", "length")
        .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
    )
    return (
        of_length.groupBy("instance", "kind")
        .agg(F.max("score").alias("score"))
        .groupBy("instance")
        .agg(F.max(F.struct("score", (-F.col("kind")).alias("back"))).alias("top"))
        .select("instance", (-F.col("top.back")).alias("kind"), "top.score")
    )


def bootstrapped(docs: DataFrame, scans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Known instances (instance, kind, score, round) and the patterns of the last round."""
    known = stored(
        scans.select(F.explode("mentions").alias("m"))
        .where("m.kind >= 0")
        .groupBy("m.instance")
        .agg(F.min("m.kind").alias("kind"))
        .select("instance", "kind", F.lit(1.0).alias("score"), F.lit(0).alias("round")),
        "pii-known",
    )
    every = stored(graph(scans), "pii-graph")
    often = stored(possible_patterns(every, known), "pii-often")
    counts = stored(occurrences(docs, often), "pii-counts")
    edges = stored(by_pattern(every, often), "pii-edges")
    for nth in range(1, MOST_ROUNDS + 1):
        patterns = stored(scored_patterns(edges, known, counts), "pii-patterns")
        new = stored(
            scored_instances(edges, patterns)
            .where(F.col("score") >= ACCEPT)
            .join(known.select("instance"), "instance", "left_anti")
            .withColumn("round", F.lit(nth)),
            "pii-new",
        )
        if new.isEmpty():
            break
        known = known.union(new)
    return known, patterns


def personal_spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base and added, arrays of (kind, start, end) in code points.

    ``added`` holds candidates that name a known instance, with its kind, by kind and start.
    """
    scans = stored(scanned(docs), "pii-scans")
    known, _ = bootstrapped(docs, scans)
    own = known.select(F.col("instance").alias("known_instance"), "kind")
    hopeful = F.exists("mentions", lambda m: m["kind"] < 0)
    found = (
        scans.where(hopeful)
        .select("high", "low", F.explode("mentions").alias("m"))
        .where("m.kind < 0")
        .select("high", "low", "m.fits", "m.start", "m.end", "m.instance")
        .distinct()  # copies of a text have the same places
        .join(own, F.col("instance") == F.col("known_instance"))
        .groupBy("high", "low")
        .agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    )
    # a text with many copies lies on PARTS keys
    found = found.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
    with_candidates = scans.where(hopeful).withColumn("part", part)
    none = F.array().cast("array<struct<kind:int,start:long,end:long>>")
    return (
        with_candidates.join(found, ["high", "low", "part"], "left")
        .select("doc_id", "base", F.coalesce("added", none).alias("added"))
        .union(scans.where(~hopeful).select("doc_id", "base", none.alias("added")))
    )


def personal_report(docs: DataFrame) -> DataFrame:
    """Per row: counts by base kind, digest of the base spans, all spans as text."""
    kinds = F.array(*(F.lit(k) for k in KINDS))

    def shown(spans, before=""):
        one = F.transform(
            spans,
            lambda s: F.concat(
                F.lit(before),
                F.element_at(kinds, s["kind"] + 1),
                F.lit(":"),
                s["start"].cast("string"),
                F.lit(":"),
                s["end"].cast("string"),
            ),
        )
        return F.array_join(one, ",")

    def count(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    base, added = shown(F.col("base")), shown(F.col("added"), "context_")
    both = F.concat(base, F.when((base != "") & (added != ""), ",").otherwise(""), added)
    return personal_spans(docs).select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(base, 256).alias("base_sha256"),
        both.alias("spans"),
    )
