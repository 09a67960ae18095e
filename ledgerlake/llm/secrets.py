"""Secret scans with one combined automaton.

All rules are compiled into one deterministic automaton (see ``automaton``). A text is
walked once, byte by byte; the state reached says which rules can match somewhere in it.
A rule with a long counted tail enters with its opening only, since counters multiply
each other's states. For the rules seen, and only for them, the places are found: the rule's own automaton runs to the first end of
a match, its reversal runs back to the leftmost start, and the rule itself forward to
the last end. Matches of a rule do not overlap; one that is too short uses up its
place and is dropped.

Defined cases: a null or empty text has no spans. Bytes beyond ASCII match no rule.
Rows are answered one by one, so repeated rows are repeated, an empty table gives no
rows, and columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.automaton import Dfa, backwards, determinise, parse
from ledgerlake.llm.common import python_workers, whole


def any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``least`` characters must follow the longest match of ``before`` (or the start).

    ``opening`` stands for the pattern in the combined automaton: whatever matches the
    pattern holds a match of it.
    """

    kind: str
    pattern: str
    least: int
    before: str = ""
    opening: str = ""


# The three base rules, and two more forms of credentials.
_NAMES = "|".join(map(any_case, ["password", "passwd", "secret", "token", "api_?key"]))
_ASSIGN = rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?"
BASE = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=\\-]+", 12, _ASSIGN, _ASSIGN + "[A-Za-z0-9+/_.=\\-]"),
    Rule("access", "AKIA[A-Z0-9]+", 18, opening="AKIA[A-Z0-9]"),
    Rule("hex", "[0-9a-f]{16,}", 16),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", 40, opening="gh[pousr]_"),
    Rule(
        "private_key",
        "-----BEGIN\\x20([A-Z]+\\x20)*PRIVATE\\x20KEY-----",
        27,
        opening="-----BEGIN\\x20",
    ),
)


class Scanner:
    """The combined automaton and, per rule, those that find its places."""

    def __init__(self, rules=BASE + MORE):
        self.rules = rules
        trees = [parse(rule.pattern) for rule in rules]
        openings = [parse(rule.opening or rule.pattern) for rule in rules]
        self.combined: Dfa = determinise(openings, search=True, sticky=True)
        self.ends = [determinise([t], search=True, sticky=False) for t in trees]
        self.starts = [determinise([backwards(t)], search=False, sticky=False) for t in trees]
        self.longest = [determinise([t], search=False, sticky=False) for t in trees]
        self.before = [
            determinise([parse(r.before)], search=False, sticky=False) if r.before else None
            for r in rules
        ]

    def ready(self) -> Scanner:
        """Lay the tables out for walking; done once in each worker."""
        self.rows = self.combined.rows()
        return self

    def hits(self, data: bytes) -> int:
        row = self.rows[self.combined.start]
        for byte in data:
            row = row[byte]
        return row[256]

    @staticmethod
    def last_end(dfa: Dfa, data: bytes, at: int) -> int:
        """The end of the longest match that begins at a place, -1 without one."""
        table, marks, state, end = dfa.table, dfa.marks, dfa.start, -1
        sink = Scanner.sink(dfa)
        for i in range(at, len(data)):
            state = table[256 * state + data[i]]
            if marks[state]:
                end = i + 1
            elif state == sink:
                break
        return end

    @staticmethod
    def sink(dfa: Dfa) -> int:
        """The state that nothing leaves and that marks nothing, -1 if there is none."""
        if not hasattr(dfa, "_sink"):
            dfa._sink = next(
                (
                    s
                    for s, mark in enumerate(dfa.marks)
                    if not mark and all(x == s for x in dfa.table[256 * s : 256 * s + 256])
                ),
                -1,
            )
        return dfa._sink

    def places(self, k: int, data: bytes) -> list[tuple[int, int]]:
        """Byte spans of rule k, leftmost first, without overlap, long enough."""
        found, at, size = [], 0, len(data)
        search, back, rule = self.ends[k], self.starts[k], self.rules[k]
        table, marks, back_sink = search.table, search.marks, self.sink(back)
        while at < size:
            state, i = search.start, at
            while i < size:
                state = table[256 * state + data[i]]
                i += 1
                if marks[state]:
                    break
            else:
                break
            state, start, j = back.start, i, i
            while j > at:
                j -= 1
                state = back.table[256 * state + data[j]]
                if back.marks[state]:
                    start = j
                elif state == back_sink:
                    break
            end = self.last_end(self.longest[k], data, start)
            value = self.last_end(self.before[k], data, start) if rule.before else start
            if end - value >= rule.least:
                found.append((start, end))
            at = end
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) of every match in code points, in order."""
        data = text.encode("utf-8", "surrogatepass")
        mask, out = self.hits(data), []
        for k in range(len(self.rules)):
            if mask >> k & 1:
                out += [(a, k, b) for a, b in self.places(k, data)]
        out.sort()
        if len(data) != len(text):  # bytes to code points; a match itself is ASCII
            before = [len(data[:a].decode("utf-8", "surrogatepass")) for a, _, _ in out]
            out = [(p, k, p + b - a) for p, (a, k, b) in zip(before, out, strict=True)]
        return out


def secret_spans(docs: DataFrame, rules=BASE + MORE) -> DataFrame:
    """Per row: doc_id and spans, an array of (kind, start, end) in code points."""
    spark = docs.sparkSession
    python_workers(spark)
    shared = spark.sparkContext.broadcast(Scanner(rules))

    def scan(batches):
        scanner = shared.value
        if not hasattr(scanner, "rows"):
            scanner.ready()
        kinds = [rule.kind for rule in scanner.rules]
        for batch in batches:
            rows = [
                [{"kind": kinds[k], "start": a, "end": b} for a, k, b in scanner.spans(text)]
                for text in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": rows})

    return docs.select(F.col("doc_id").cast("long"), whole("text").alias("text")).mapInPandas(
        scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    )


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row: counts by base kind, digest of the base spans, all spans as text."""

    def kept(kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def shown(spans):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(one, ",")

    def count(kind):
        return F.size(kept([kind])).cast("long")

    return secret_spans(docs).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(shown(kept([r.kind for r in BASE])), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )
