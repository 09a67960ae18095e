"""Quality by hierarchical empirical Bayes.

A logistic classifier, fitted on a bounded sample of labelled documents, gives each text
its evidence: the log-odds of good over bad, without the prior of the sample. Its
probabilities are summed per host and per path of a host by grouped aggregation. A host's
rate is shrunk towards the rate of all documents and a path's rate towards its host's, the
more the fewer documents it has; how strongly is read off the spread of the rates
themselves (method of moments). A document's posterior joins its own evidence with the
rate of its path, from which its own share is taken out.

Documents have no address. Their source stands for the host and their language for the
path below it; both columns are parameters.

Parameters with bounds: SAMPLE, the expected number of labelled rows the classifier is
fitted on. The driver holds those rows' features (21 numbers each), the fitted weights and
a handful of totals.

Defined cases: a null text is empty and judged as such. Null hosts and paths are groups of
their own. Labels that are null, or whose document is missing, are not used; of several
labels of a document each counts. Rows that share an id, or have none, are judged one by
one. Without labels of both kinds the evidence is 0 and every
document has the prior rate (START). Rows that repeat are judged alike and returned each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import digest_of, fresh_name, python_workers, stored, whole

SAMPLE = 20_000
START = 0.8
REJECT = 0.5
STRENGTH = (2.0, 2000.0)  # bounds of a group's prior in documents
_FLOOR = 0.02

# Very common words of four languages.
COMMON = frozenset(
    "the of and to in a is that it on for was with as be by this are at or an from not "
    "der die und das den von zu mit ist im für auf dem ein eine des sich nicht als auch "
    "le la les de et un une des du en que est pour dans qui sur pas avec par au "
    "el los las y que en del se por con una para es no su lo al".split()
)
_MARKS = b"!?|#$%&*.,:;"
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_OTHER = np.zeros(256, dtype=bool)
_OTHER[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
FEATURES = 10 + len(_MARKS)


def features(text: str) -> np.ndarray:
    """What the classifier sees of a whole text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    size = max(1, len(data))
    counts = np.bincount(data, minlength=256)
    words = text.split()
    number = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    distinct = set(words)
    plain = sum(word.strip(".,").lower() in COMMON for word in words)
    shares = [
        counts[_UPPER].sum() / size,
        counts[_DIGIT].sum() / size,
        counts[_OTHER].sum() / size,
        plain / number,
        len(distinct) / number,
        len(set(lines)) / max(1, len(lines)),
        sum(map(len, words)) / number / 10,
        np.log1p(number) / 10,
        np.log1p(number / max(1, len(lines))) / 10,
        float(not words),
    ]
    # shares of single marks are small where they matter; a root spreads them
    marks = np.sqrt(counts[list(_MARKS)] / number)
    return np.concatenate([shares, np.minimum(marks, 2.0)])


def fitted(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, the constant last.

    The constant is that of the sample; ``evidence`` takes the sample's log-odds out.
    """
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - ridge * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    scaled = w[:-1] / spread
    return np.append(scaled, w[-1] - scaled @ mean)


def sample_features(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Features and labels of about ``sample`` labelled documents, chosen by a hash of the id."""
    python_workers(docs.sparkSession)
    known = labels.where("quality is not null and doc_id is not null")
    count = known.count()
    share = min(1.0, sample / max(1, count))
    chosen = known.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    ).select(F.col("doc_id").alias("labelled"), "quality")

    def read(batches):
        for batch in batches:
            yield pd.DataFrame(
                {
                    "x": [features(text).tolist() for text in batch["text"]],
                    "y": batch["quality"].astype("float64"),
                }
            )

    # about ``sample`` rows of two numbers: a bounded side
    found = (
        docs.select("doc_id", whole("text").alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select("text", "quality")
        .mapInPandas(read, "x array<double>, y double")
        .toArrow()
    )
    x = np.array(found["x"].to_pylist(), dtype=float).reshape(-1, FEATURES)
    return x, (found["y"].to_numpy() > 0.5).astype(float)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights that give a text's evidence."""
    x, y = sample_features(docs, labels, sample)
    if not 0 < y.sum() < len(y):
        return np.zeros(FEATURES + 1)
    order = np.lexsort(np.column_stack([x, y]).T)  # the same sums whatever the row order
    weights = fitted(x[order], y[order])
    weights[-1] -= np.log(y.mean() / (1 - y.mean()))
    return weights


def row_digest(host: Column, path: Column) -> Column:
    """Names a row by all that its verdict depends on, as ids may repeat or be missing."""
    return digest_of(F.col("doc_id"), host, path, whole("text"))


def evidence(docs: DataFrame, weights: np.ndarray, host: Column, path: Column) -> DataFrame:
    """Per row: doc_id, host, path, row_digest and evidence, the log-odds its text alone
    speaks for."""
    python_workers(docs.sparkSession)

    def read(batches):
        for batch in batches:
            x = np.array([features(t) for t in batch["text"]]).reshape(-1, FEATURES)
            score = np.clip(x @ weights[:-1] + weights[-1], -12, 12)
            yield batch.drop(columns="text").assign(evidence=score).astype({"doc_id": "Int64"})

    rows = docs.select(
        F.col("doc_id").cast("long"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        row_digest(host, path).alias("row_digest"),
        whole("text").alias("text"),
    )
    return rows.mapInPandas(
        read, "doc_id long, host string, path string, row_digest binary, evidence double"
    )


def strength(rates: DataFrame, towards: str) -> float:
    """How many documents a prior is worth, from the spread of group rates around it.

    Groups that differ no more than chance allows get the strongest prior.
    """
    n, rate, prior = F.col("n"), F.col("total") / F.col("n"), F.col(towards)
    row = rates.agg(
        F.sum(n * (rate - prior) ** 2),
        F.sum(prior * (1 - prior)),
        F.sum(n * prior * (1 - prior)),
        F.sum(n),
    ).first()
    spread, chance, mixed, count = (float(v or 0) for v in row)
    low, high = STRENGTH
    if count == 0 or spread <= chance or mixed == 0:
        return high
    between = (spread - chance) / count
    return float(np.clip(mixed / count / between - 1, low, high))


def _log_odds(p: Column) -> Column:
    q = F.greatest(F.lit(_FLOOR), F.least(F.lit(1 - _FLOOR), p))
    return F.log(q / (1 - q))


def posteriors(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    sample: int = SAMPLE,
    reject: float = REJECT,
) -> DataFrame:
    """Per row: row_digest, doc_id, p_text, host_rate, path_rate, posterior and kept."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = stored(evidence(docs, train(docs, labels, sample), host, path), "quality-evidence")
    odds = float(np.log(START / (1 - START)))
    rows = rows.withColumn("p_text", 1 / (1 + F.exp(-(F.col("evidence") + odds))))

    paths = rows.groupBy("host", "path").agg(F.sum("p_text").alias("total"), F.count("*").alias("n"))
    paths = stored(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    hosts = stored(hosts, "quality-hosts")
    total, count = hosts.agg(F.sum("total"), F.sum("n")).first()
    overall = float(total) / count if count else START
    hosts = hosts.withColumn("overall", F.lit(overall))
    weight = strength(hosts, "overall")
    hosts = hosts.select(
        F.col("host").alias("of_host"),
        ((F.col("total") + weight * overall) / (F.col("n") + weight)).alias("host_rate"),
    )
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
    weight = strength(paths, "host_rate")
    paths = stored(
        paths.select(
            "of_host",
            F.col("path").alias("of_path"),
            "host_rate",
            (F.col("total") + weight * F.col("host_rate")).alias("path_total"),
            (F.col("n") + weight).alias("path_n"),
        ),
        "quality-rates",
    )
    same = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    others = (F.col("path_total") - F.col("p_text")) / (F.col("path_n") - 1)
    joint = F.col("evidence") + _log_odds(others)
    posterior = 1 / (1 + F.exp(-joint))
    return rows.join(paths, same).select(
        "row_digest",
        "doc_id",
        "p_text",
        "host_rate",
        (F.col("path_total") / F.col("path_n")).alias("path_rate"),
        posterior.alias("posterior"),
        (posterior >= reject).alias("kept"),
    )


def judged(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """Per row: doc_id, p_text, host_rate, path_rate, posterior and kept."""
    return posteriors(docs, labels, **parameters).drop("row_digest")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    rejected = fresh_name(docs, "rejected")
    gone = posteriors(docs, labels).where("not kept")
    gone = gone.select(F.col("row_digest").alias(rejected))
    digest = row_digest(F.col("source"), F.col("lang"))
    return docs.join(gone, digest == F.col(rejected), "left_anti")
