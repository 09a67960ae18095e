"""Personal data: rules against their patterns, bootstrapping against a plain version."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from ledgerlake.llm import pii
from ledgerlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def ruled(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            number = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(number) <= 19 and luhn(number),
                "phone": 9 <= len(number) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def report(text, added=()):
    base = ruled(text)
    shown = [f"{k}:{a}:{b}" for k, a, b in base]
    counts = [sum(k == kind for k, _, _ in base) for kind in RULES]
    digest = hashlib.sha256(",".join(shown).encode()).hexdigest()
    return (*counts, digest, ",".join(shown + [f"context_{k}:{a}:{b}" for k, a, b in added]))


def test_rules_on_random_texts():
    draw = random.Random(9)
    for alphabet in ("a1@.- ", "0123.+( )-9", "1.2@+-a ", "4 -1", "é@a.1漢+", "12. ", "@.a"):
        for _ in range(4000):
            text = "".join(draw.choices(alphabet, k=draw.randrange(30)))
            assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == ruled(text), text


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "@" * 300_000,
                "a@" * 150_000, "+1" * 150_000, "a:" * 150_000, "(at)" * 75_000, "1-" * 150_000 + "x"):
        assert pii.mentions_of(run, pii.base_spans(run)) is not None


def plain_bootstrap(texts):
    """The whole method over lists and dictionaries, with words as they stand."""
    separators = "[" + re.escape(pii.SEPARATORS.decode()) + "]+"
    seen, edges, counts = {}, defaultdict(int), defaultdict(int)
    fits_of, mentions = defaultdict(int), []
    for number, text in enumerate(texts):
        words = [m for m in re.finditer(f"[^{re.escape(pii.SEPARATORS.decode())}]+", text)]
        assert re.split(separators, text) is not None
        lowered = [re.sub("[A-Z]", lambda m: m.group().lower(), w.group()) for w in words]
        for i in range(len(words)):
            for n in range(1, 4):
                if i + 1 >= n:
                    counts[tuple(lowered[i + 1 - n : i + 1])] += 1
        base = pii.base_spans(text)
        found = [(k, 0, a, b, pii.base_name(k, text[a:b])) for k, a, b in base]
        found += [(-1, *c) for c in pii.apart(pii.candidates(text), base)]
        behind = set()
        order = sorted(range(len(found)), key=lambda i: (found[i][2], i))
        for kind, fits, a, b, instance in (found[i] for i in order):
            before = [w for w, m in zip(lowered, words, strict=True) if m.end() <= a]
            if kind >= 0:
                seen[instance] = min(kind, seen.get(instance, 9))
            else:
                mentions.append((number, a, b, instance))
            follows = len(before) not in behind
            behind.add(len(before))
            for n in range(1, 4):
                if len(before) >= n and follows:
                    pattern = tuple(before[-n:])
                    edges[pattern, instance] += 1
                    fits_of[pattern, instance] |= fits
    per_pattern = defaultdict(list)
    for (pattern, instance), times in edges.items():
        per_pattern[pattern].append((instance, times, fits_of[pattern, instance]))
    for _ in range(pii.MOST_ROUNDS):
        trusted = defaultdict(dict)
        for pattern, met in per_pattern.items():
            for kind in range(4):
                own = [(i, t) for i, t, _ in met if seen.get(i) == kind]
                unknown = sum(t for i, t, f in met if i not in seen and f >> kind & 1)
                share = sum(t for _, t in own) / (counts[pattern] - 0.75 * unknown + 1)
                if len(own) >= 5 and share >= 0.6:
                    trusted[pattern][kind] = min(0.99, share)
        left = defaultdict(lambda: 1.0)
        for pattern, kinds in trusted.items():
            for instance, _, fits in per_pattern[pattern]:
                for kind, share in kinds.items():
                    if instance not in seen and fits >> kind & 1:
                        left[instance, kind, len(pattern)] *= 1 - share
        best = defaultdict(list)
        for (instance, kind, _), rest in left.items():
            if 1 - rest >= 0.8:
                best[instance].append((rest, kind))
        if not best:
            break
        seen.update({instance: min(found)[1] for instance, found in best.items()})
    added = defaultdict(list)
    for number, a, b, instance in mentions:
        if instance in seen:
            added[number].append((seen[instance], a, b))
    return [sorted(added[i]) for i in range(len(texts))]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    words = "the of and is old house é cat a ran".split()

    def prose(n):
        return " ".join(draw.choices(words, k=n))

    def number(n):
        return "".join(draw.choices("0123456789", k=n))

    rows = []
    for i in range(40):
        rows.append(f"{prose(9)} Call me at: +1 ({number(3)}) {number(3)}-{number(4)} {prose(3)}")
        rows.append(f"{prose(5)}, write to user{i}@mail{i % 3}.example.com {prose(4)}")
        rows.append(f"{prose(5)} order {number(8)} {prose(4)}")
    for i in range(12):
        rows.append(f"é {prose(4)} call ME at: {number(3)}-{number(4)} {prose(2)}")
        rows.append(f"{prose(5)}, write to some{i} (at) mail (dot) example (dot) org {prose(2)}")
    known = [r.split("at: ")[1].split(" ")[0].replace("-", ".") for r in rows if "call ME" in r]
    rows += [f"{prose(3)} mobile no {n} {prose(2)}" for n in known]  # the same in another spelling
    rows += [f"{prose(3)} mobile no {number(8)}. {prose(2)} +1 838 555 95 {i}7" for i in range(6)]
    rows += [rows[0].replace("(", "").replace(")", "").replace("+", "")] * 40  # copies
    rows += ["", "   ", "at: 5551234", "call me at: 555-12345x", "host fe80:1:2:3:4:5 up"]
    return rows


def test_bootstrapping_finds_what_no_rule_does(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' as base", "1 as high", "2 as mentions")
    added = plain_bootstrap(texts)
    expected = {
        (i, *report(t, [(pii.KINDS[k], x, y) for k, x, y in a]))
        for (i, t), a in zip(rows, added, strict=True)
    }
    found = {tuple(r) for r in pii.personal_report(docs).collect()}
    assert found == expected
    spans = {r[0]: r[-1] for r in found}
    assert all("context_phone" in spans[i] for i, t in rows if "call ME at" in t)
    assert all("context_email" in spans[i] for i, t in rows if "(at)" in t)
    assert all("context_phone" in spans[i] for i, t in rows if "mobile no" in t)  # a later round
    assert not any("context" in spans[i] for i, t in rows if " order " in t)


def test_given_and_odd_rows(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = {tuple(r) for r in QUERIES["op11_pii"](spark, FOLDER).collect()}
    rows = given.collect()
    added = plain_bootstrap([r.text or "" for r in rows])
    assert found == {
        (r.doc_id, *report(r.text or "", [(pii.KINDS[k], x, y) for k, x, y in a]))
        for r, a in zip(rows, added, strict=True)
    }
    odd = [(None, None), (None, "a@b.c"), (None, "a@b.c"), (1, ""), (1, "é+1 234 567 890"), (1, "x")]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    rows = sorted((tuple(r) for r in pii.personal_report(docs).collect()), key=str)
    assert rows == sorted(((i, *report(t or "")) for i, t in odd), key=str)
    assert pii.personal_report(docs.limit(0)).count() == 0
