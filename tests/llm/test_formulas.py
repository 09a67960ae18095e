"""The formulas of language, SpotSigs and quality in plain Python, over the given tables."""

import math
from collections import defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from ledgerlake.llm import language, packing, quality, spots
from ledgerlake.llm.common import table

FOLDER = "/root/testdata/sf0.001"


# --- SpotSigs ---------------------------------------------------------------------------


def plain_signatures(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w] or text.split()
    anchors = set(spots.ANCHORS)
    content = [w for w in words if w not in anchors]
    found, before = set(), 0
    for i, word in enumerate(words):
        following = [*words[i + 1 : i + 3], None, None][:2]
        if word in anchors:
            found.add(("chain", word, *[*content[before : before + 2], None, None][:2]))
        elif not any(w in anchors for w in words[max(0, i - spots.STRETCH + 1) : i]):
            found.add(("lone", word, *following))
        before += word not in anchors
    return found


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    part = [math.floor(math.log(len(x)) / math.log(1 / spots.FLOOR)) for x in (a, b)]
    low, high = sorted((len(a), len(b)))
    if abs(part[0] - part[1]) > 1 or low < spots.FLOOR * high:
        return 0.0
    return len(a & b) / len(a | b)


def test_signatures_and_likeness(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    extra = [(-1, "the"), (-2, "the the of a"), (-3, "x y z"), (-4, ""), (-5, None), (-6, "# %% #")]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    own = [plain_signatures(text) for _, text in rows]
    found = {r.doc_id: r for r in spots.fingerprints(docs).collect()}
    for i, (doc_id, text) in enumerate(rows):
        r, k = found[doc_id], (i + 1) % len(rows)
        half = len(text) // 2
        edited = plain_signatures(text[: len(text) - half] + rows[k][1][:half])
        assert len(r.fingerprint) == 16 * len(own[i]), doc_id
        assert len(r.edited_fingerprint) == 16 * len(edited)
        assert r.near_next == pytest.approx(plain_likeness(own[i], own[k]), abs=1e-12)
        assert r.near_edited == pytest.approx(plain_likeness(own[i], edited), abs=1e-12)


# --- quality ----------------------------------------------------------------------------


def plain_strength(groups):
    """groups: (n, total, prior); how many documents a prior is worth."""
    spread = sum(n * (total / n - p) ** 2 for n, total, p in groups)
    chance = sum(p * (1 - p) for _, _, p in groups)
    mixed = sum(n * p * (1 - p) for n, _, p in groups)
    count = sum(n for n, _, _ in groups)
    low, high = quality.STRENGTH
    if not count or spread <= chance or not mixed:
        return high
    return min(high, max(low, mixed / count / ((spread - chance) / count) - 1))


def test_posteriors(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    place = {r.doc_id: (r.source, r.lang) for r in docs.select("doc_id", "source", "lang").collect()}
    rows = quality.judged(docs, labels).collect()
    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for r in rows:
        for groups, key in ((hosts, place[r.doc_id][0]), (paths, place[r.doc_id])):
            groups[key][0] += 1
            groups[key][1] += r.p_text
    overall = sum(t for _, t in hosts.values()) / len(rows)
    weight = plain_strength([(n, t, overall) for n, t in hosts.values()])
    host_rate = {h: (t + weight * overall) / (n + weight) for h, (n, t) in hosts.items()}
    weight = plain_strength([(n, t, host_rate[h]) for (h, _), (n, t) in paths.items()])
    odds = math.log(quality.START / (1 - quality.START))
    for r in rows:
        host, path = place[r.doc_id][0], place[r.doc_id]
        n, total = paths[path][0] + weight, paths[path][1] + weight * host_rate[host]
        assert r.host_rate == pytest.approx(host_rate[host], abs=1e-9)
        assert r.path_rate == pytest.approx(total / n, abs=1e-9)
        others = min(0.98, max(0.02, (total - r.p_text) / (n - 1)))
        evidence = math.log(r.p_text / (1 - r.p_text)) - odds
        joint = evidence + math.log(others / (1 - others))
        assert r.posterior == pytest.approx(1 / (1 + math.exp(-joint)), abs=1e-6)
        assert r.kept == (r.posterior >= quality.REJECT)


def test_sparse_sites_shrink_towards_the_whole(spark):
    """One bad text at a site of its own moves little, a hundred of them much."""
    good = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    junk = "!!! $$$ %%% BUY BUY BUY ### ??? " * 20
    few = spark.createDataFrame(
        [(10**7 + i, junk, "en", "few" if i == 0 else "many") for i in range(101)],
        "doc_id long, text string, lang string, source string",
    )
    docs = good.select(*few.columns).union(few)
    rate = {r.doc_id: r.host_rate for r in quality.judged(docs, labels).where("doc_id >= 10000000").collect()}
    assert rate[10**7] > rate[10**7 + 1]


# --- language ---------------------------------------------------------------------------


def test_language_of_texts_not_trained_on(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("lang is not null")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    languages, model = language.train(docs.where(half))
    right = total = 0
    for r in docs.where(~half).select("text", "lang").collect():
        scores = language.likelihoods(r.text or "", model)
        right += languages[int(np.argmax(scores))] == r.lang
        total += 1
    assert total > 300 and right / total > 0.95


def test_fusion_of_evidence(spark):
    docs, pages = table(spark, FOLDER, "documents"), table(spark, FOLDER, "pages")
    languages, model = language.train(docs)
    each = range(len(languages))
    host = language.host_of(F.col("url"))
    label = F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([^.]+)$", 1)
    suffix = F.when(label != "", label)
    lines = docs.selectExpr(
        "doc_id", "cast(null as long) page_id", "source host", "cast(null as string) suffix",
        "coalesce(text, '') text", "cast(null as string) html",
    ).union(
        pages.select(
            F.lit(None).cast("long"), "page_id", host, suffix, F.lit(None).cast("string"),
            F.coalesce("html", F.lit("")),
        )
    )
    rows = language.text_evidence(lines, model).collect()
    shares = []
    for r in rows:
        weights = [math.exp(s - max(r.scores)) for s in r.scores]
        shares.append([w / sum(weights) for w in weights])
    sums, suffixes, said = (defaultdict(lambda: [0.0] * (len(languages) + 1)) for _ in range(3))
    for r, p in zip(rows, shares, strict=True):
        for groups, key in ((sums, (r.host, r.suffix)), (suffixes, r.suffix), (said, r.declared)):
            groups[key] = [x + y for x, y in zip(groups[key], [*p, 1.0], strict=True)]
    said.pop(None, None)
    overall = [(sum(s[i] for s in suffixes.values()) + 1) / (len(rows) + len(languages)) for i in each]
    all_said = [sum(s[i] for s in said.values()) for i in range(len(languages) + 1)]
    found = {(r.doc_id, r.page_id): r for r in language.identify(docs, pages).collect()}
    for r, p in zip(rows, shares, strict=True):
        of_host, of_suffix = sums[r.host, r.suffix], suffixes[r.suffix]
        joint = []
        for i in each:
            prior = (of_suffix[i] + 20 * overall[i]) / (of_suffix[-1] + 20)
            own = max(1e-6, of_host[i] + 5 * prior - p[i]) / (of_host[-1] + 5 - 1)
            score = r.scores[i] + math.log(own)
            if r.declared is not None:
                named = said[r.declared]
                score += math.log((named[i] + 2 * named[-1] / all_said[-1]) / (all_said[i] + 2))
            joint.append(score)
        answer = found[r.doc_id, r.page_id]
        mass = sum(math.exp(s - max(joint)) for s in joint)
        assert answer.confidence == pytest.approx(1 / mass, abs=2e-6)
        assert answer.lang == max(zip(joint, languages, strict=True))[1]


# --- packing ----------------------------------------------------------------------------


def plain_best_fit(lengths, size):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fit = [i for i, gap in enumerate(gaps) if gap >= length]
        if fit:
            gaps[min(fit, key=lambda i: gaps[i])] -= length
        else:
            gaps.append(size - length)
    return len(gaps)


def test_packing_is_no_worse_than_best_fit_alone():
    draw = np.random.Generator(np.random.PCG64(8))
    for lengths in (
        draw.integers(1, 4097, 200),
        draw.integers(1, 4097, 1500),
        draw.integers(1000, 2500, 600),
        np.minimum(4096, draw.geometric(1 / 900, 800)),
    ):
        counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)}
        runs, number = packing.pack(counts)
        assert number <= plain_best_fit(lengths.tolist(), 4096)
        assert sum(run[2] for run in runs) == len(lengths)
