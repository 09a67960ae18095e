"""Language identification by Bayesian fusion of evidence.

Three kinds of evidence are multiplied:

* the likelihood of the text under a model of byte trigrams per language, fitted on a
  bounded sample of documents with a language label;
* the likelihood of the language that the page's markup declares, from how often pages of
  each language declare it;
* the prior of the page's host, shrunk towards that of its address suffix, which is
  shrunk towards that of all rows, each from sums of the text posteriors by grouped
  aggregation. A row's own share is taken out of its host's.

Documents take part without markup or suffix; their source is their host.

Parameters with bounds: SAMPLE, the expected number of labelled documents the model is
fitted on, and LEAST, how many of one language there are to be at least (all of a rarer one).
The driver holds the model, BUCKETS numbers for each language that labels name.

Defined cases: a null or empty text has no text evidence and gets the language its other
evidence favours. Null hosts, suffixes and declarations are no evidence of their own: a
null host is a group like any other, a null declaration counts for nothing. Rows that
repeat are answered each. Without any labelled document the language is null. Ties go to
the later code. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import python_workers, stored, whole

SAMPLE = 5000
LEAST = 200
BUCKETS = 1 << 16
#: Trigrams of one text depend on each other: no text counts as more than this many.
EVIDENCE = 60
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 5.0, 20.0, 2.0
_PART = 1 << 20

_KEPT = np.full(256, 0x20, dtype=np.uint32)
_KEPT[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEPT[0x80:] = np.arange(0x80, 0x100)
_SILENT = re.compile(r"<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
_TAG = re.compile(r"<[/a-zA-Z!?][^>]*(?:>|\Z)")
_HEAD_TAG = re.compile(r"<(html|meta)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_CODE = re.compile(r"\s*([a-zA-Z]{2,8})")


def trigrams(text: str) -> np.ndarray:
    """Bucket numbers of a text's letter trigrams, word ends included."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    letters = _KEPT[data]
    gap = letters == 0x20
    letters = letters[~(gap & np.concatenate([[True], gap[:-1]]))] if len(letters) else letters
    if len(letters) < 3:
        return np.zeros(0, dtype=np.uint32)
    mixed = letters[:-2] * 40503 + letters[1:-1] * 10007 + letters[2:] * 331
    return (mixed ^ (mixed >> 13)) & (BUCKETS - 1)


def visible(html: str) -> str:
    return unescape(_TAG.sub(" ", _SILENT.sub(" ", html)))


def declared(html: str) -> str | None:
    """The language a page's markup names, without its region.

    The html element's own lang comes first, then a meta element for the content's
    language; comments and scripts declare nothing.
    """
    named = None
    for tag, text in _HEAD_TAG.findall(_SILENT.sub(" ", html)):
        attributes: dict[str, str] = {}
        for name, value in _ATTRIBUTE.findall(text):
            attributes.setdefault(name.lower(), value.strip("\"'"))
        if tag.lower() == "html":
            code = _CODE.match(attributes.get("lang") or attributes.get("xml:lang") or "")
            if code:
                return code[1].lower()
        elif attributes.get("http-equiv", attributes.get("name", "")).lower() == "content-language":
            code = _CODE.match(attributes.get("content", ""))
            named = named or (code[1].lower() if code else None)
    return named


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in order and, per language and bucket, the log of its share."""
    python_workers(docs.sparkSession)
    known = docs.where("lang is not null and doc_id is not null")
    counts = known.groupBy(F.col("lang").alias("of_lang")).agg(F.count("*").alias("n"))
    total = Window.partitionBy()  # one row per language
    share = F.greatest(F.lit(sample) / F.sum("n").over(total), F.lit(LEAST) / F.col("n"))
    shares = stored(
        counts.select("of_lang", F.floor(F.least(F.lit(1.0), share) * (1 << 20)).alias("bound")),
        "language-shares",
    )
    # a row per language: the model below has 65,536 numbers for each on the driver
    chosen = (
        known.select("doc_id", "lang", whole("text").alias("text"))
        .join(F.broadcast(shares), F.col("lang") == F.col("of_lang"))
        .where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.col("bound"))
        .select("lang", "text")
    )

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in sums.items():
            there = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": there, "times": own[there]})

    found = (
        chosen.mapInPandas(count, "lang string, bucket long, times long")
        .groupBy("lang", "bucket")
        .agg(F.sum("times").alias("times"))
        .toArrow()
    )
    languages = sorted(set(found["lang"].to_pylist()))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.full((len(languages), BUCKETS), 0.5)
    rows = [place[lang] for lang in found["lang"].to_pylist()]
    counts[rows, found["bucket"].to_numpy()] += found["times"].to_numpy()
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def likelihoods(text: str, model: np.ndarray) -> np.ndarray:
    """Log-likelihood of a text per language, for at most EVIDENCE trigrams' worth."""
    found = trigrams(text)
    if not len(found) or not len(model):
        return np.zeros(len(model))
    total = np.zeros(len(model))
    for at in range(0, len(found), _PART):
        part = found[at : at + _PART]
        if len(part) > BUCKETS:
            total += model @ np.bincount(part, minlength=BUCKETS).astype(np.float32)
        else:
            total += model[:, part].sum(axis=1, dtype=np.float64)
    total *= min(1.0, EVIDENCE / len(found))
    return total - total.max()


def text_evidence(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Per row: ids, host, suffix, the declared language, and text likelihoods.

    ``rows`` has doc_id, page_id, host, suffix, text and html; a page has html, a document
    text.
    """
    spark = rows.sparkSession
    python_workers(spark)
    shared = spark.sparkContext.broadcast(model)

    def read(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            pages = batch.column("html").to_pylist()
            names = [declared(page) if page else None for page in pages]
            scores = [
                likelihoods(visible(page) if page is not None else text or "", shared.value)
                for text, page in zip(texts, pages, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "page_id", "host", "suffix")),
                    pa.array(names, pa.string()),
                    pa.array([s.tolist() for s in scores], pa.list_(pa.float64())),
                ],
                names=["doc_id", "page_id", "host", "suffix", "declared", "scores"],
            )

    return rows.mapInArrow(
        read,
        "doc_id long, page_id long, host string, suffix string, declared string, "
        "scores array<double>",
    )


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without port; null where there is none."""
    host = F.regexp_extract(
        F.lower(F.coalesce(url, F.lit(""))), r"^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1
    )
    return F.when(host != "", host)


def fused(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Join the text likelihoods with markup and host priors; see the module."""
    each = range(len(languages))
    top = F.array_max("scores")
    weights = [F.exp(F.col("scores")[i] - top) for i in each]
    total = sum(weights, F.lit(0.0))
    rows = evidence.select(
        "*",
        *(F.col("scores")[i].alias(f"s{i}") for i in each),
        *((w / total).alias(f"p{i}") for i, w in zip(each, weights, strict=True)),
    ).drop("scores")
    rows = stored(rows, "language-evidence")

    def sums(df, prefix):
        return [F.sum(f"p{i}").alias(f"{prefix}{i}") for i in each]

    hosts = stored(
        rows.groupBy("host", "suffix").agg(*sums(rows, "h"), F.count("*").alias("hn")),
        "language-hosts",
    )
    suffixes = hosts.groupBy(F.col("suffix").alias("of_suffix")).agg(
        *(F.sum(f"h{i}").alias(f"x{i}") for i in each), F.sum("hn").alias("xn")
    )
    suffixes = stored(suffixes, "language-suffixes")
    row = suffixes.agg(*(F.sum(f"x{i}") for i in each), F.sum("xn")).first()
    count = row[-1] or 0
    overall = [((row[i] or 0.0) + 1) / (count + len(languages)) for i in each]
    suffix_prior = [
        (F.col(f"x{i}") + SUFFIX_WEIGHT * overall[i]) / (F.col("xn") + SUFFIX_WEIGHT) for i in each
    ]
    hosts = stored(
        hosts.join(suffixes, F.col("suffix").eqNullSafe(F.col("of_suffix"))).select(
            F.col("host").alias("of_host"),
            "of_suffix",
            "hn",
            *((F.col(f"h{i}") + HOST_WEIGHT * suffix_prior[i]).alias(f"h{i}") for i in each),
        ),
        "language-priors",
    )
    said = rows.where("declared is not null")
    names = stored(
        said.groupBy(F.col("declared").alias("said")).agg(
            *sums(said, "d"), F.count("*").alias("dn")
        ),
        "language-declared",
    )
    row = names.agg(*(F.sum(f"d{i}") for i in each), F.sum("dn")).first()
    all_said = row[-1] or 0
    likely = names.select(
        "said",
        *(
            F.log(
                (F.col(f"d{i}") + DECLARED_WEIGHT * F.col("dn") / all_said)
                / ((row[i] or 0.0) + DECLARED_WEIGHT)
            ).alias(f"d{i}")
            for i in each
        ),
    )
    joined = rows.join(
        hosts,
        F.col("host").eqNullSafe(F.col("of_host"))
        & F.col("suffix").eqNullSafe(F.col("of_suffix")),
    ).join(likely, F.col("declared") == F.col("said"), "left")
    prior = [
        F.log(
            F.greatest(F.lit(1e-6), F.col(f"h{i}") - F.col(f"p{i}"))
            / (F.col("hn") + HOST_WEIGHT - 1)
        )
        for i in each
    ]
    joint = [F.col(f"s{i}") + prior[i] + F.coalesce(f"d{i}", F.lit(0.0)) for i in each]
    options = F.array(
        *(F.struct(j.alias("score"), F.lit(languages[i]).alias("lang")) for i, j in enumerate(joint))
    )
    spoken = F.array(
        *(F.struct(F.col(f"s{i}").alias("score"), F.lit(languages[i]).alias("lang")) for i in each)
    )
    result = joined.select(
        "doc_id", "page_id", "host", "suffix", "declared",
        options.alias("options"),
        F.array_max(spoken)["lang"].alias("text_lang"),
    )
    best = F.array_max("options")
    mass = F.aggregate(
        "options", F.lit(0.0), lambda t, o: t + F.exp(o["score"] - F.array_max("options")["score"])
    )
    return result.select(
        "doc_id",
        "page_id",
        best["lang"].alias("lang"),
        F.round(1 / mass, 6).alias("confidence"),
        "text_lang",
        "declared",
        "host",
        "suffix",
    )


def identify(docs: DataFrame, pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document and page: doc_id or page_id, lang, confidence, and what spoke for it."""
    languages, model = train(docs, sample)
    none = F.lit(None).cast("string")
    host = host_of(F.col("url"))
    label = F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([^.]+)$", 1)
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.lit(None).cast("long").alias("page_id"),
        F.col("source").cast("string").alias("host"),
        none.alias("suffix"),
        whole("text").alias("text"),
        none.alias("html"),
    ).union(
        pages.select(
            F.lit(None).cast("long"),
            F.col("page_id").cast("long"),
            host,
            F.when(label != "", label),
            none,
            whole("html"),
        )
    )
    if not languages:
        return rows.select(
            "doc_id", "page_id", none.alias("lang"), F.lit(None).cast("double").alias("confidence"),
            none.alias("text_lang"), none.alias("declared"), "host", "suffix",
        )
    return fused(text_evidence(rows, model), languages)
