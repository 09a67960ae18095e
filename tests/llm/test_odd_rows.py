"""Every operator and stage on nulls in all columns, empty tables and clashing names."""

import hashlib
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import archive, exact, html, language, minhash, mixing, packing
from ledgerlake.llm import quality, secrets, spots

FOLDER = "/root/testdata/sf0.001"
PROSE = "the cat of the old house sat on a warm wall and it looked at every bird " * 3
GIVEN = {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html"}
#: Every name that a module gives to a column of its own, where it could clash with a given one.
NAMES = sorted(
    {
        name
        for module in (archive, exact, html, language, minhash, mixing, packing, quality, secrets, spots)
        for name in re.findall(
            r'(?:alias|withColumn|withColumnRenamed)\(\s*"(\w+)"', Path(module.__file__).read_text()
        )
    }
    | {"rejected", "kept_id", "gone_id", "of_id", "copies", "copy"}
)


def widened(df):
    return df.select("*", *[F.lit("clash").alias(n) for n in NAMES if n not in GIVEN])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (None, PROSE, None, "a", None),
        (1, None, "en", None, 0),
        (2, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (3, PROSE + "and more", None, "a", None),
        (4, "", "en", "a", 0),
    ]
    return widened(
        spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long"
        )
    ).cache()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(None, None, None), (1, None, "<p>" + PROSE), (1, None, "<p>" + PROSE), (2, "u", None)]
    return widened(spark.createDataFrame(rows, "page_id long, url string, html string")).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(None, None, None), (None, 1, 0), (2, None, None), (2, 1, 0), (4, 0, 0), (9, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").cache()


OF_DOCS = {
    "fingerprints": lambda d: spots.fingerprints(d),
    "exact": lambda d: exact.exact_groups(d),
    "minhash": lambda d: minhash.near_groups(d, words=4, percent=80),
    "mixing": lambda d: mixing.plan(d),
    "packing": lambda d: packing.pack_documents(d),
    "secrets": lambda d: secrets.secret_report(d),
}


@pytest.mark.parametrize("name", sorted(OF_DOCS))
def test_document_operators(docs, name):
    found = OF_DOCS[name](docs).collect()
    assert len(found) == docs.count()  # no text here is longer than one sequence
    assert OF_DOCS[name](docs.limit(0)).count() == 0


def test_operators_with_a_second_table(docs, pages, labels):
    assert quality.judged(docs, labels).count() == docs.count()
    assert quality.judged(docs, labels.limit(0)).count() == docs.count()
    assert quality.judged(docs.limit(0), labels).count() == 0
    assert language.identify(docs, pages).count() == docs.count() + pages.count()
    assert language.identify(docs.limit(0), pages.limit(0)).count() == 0


def test_rows_with_one_id_are_judged_one_by_one(docs, labels):
    rows = quality.posteriors(docs, labels, reject=0.79).collect()
    assert len({bytes(r.row_digest) for r in rows}) == docs.distinct().count()


@pytest.fixture(scope="module")
def shared_ids(spark):
    """A third of the rows without an id and a third with one id, in sources of unlike size."""
    rows = []
    for i in range(360):
        doc_id = (None, 7, 100 + i)[i % 3]
        rows.append((doc_id, f"{PROSE} number {i % 300} of many", "en", "abb"[i % 3] + "x" * (i > 50), i))
    rows += rows[:9]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).cache()


def test_exact_copies_of_rows_that_share_ids(spark, docs, shared_ids):
    small = spark.createDataFrame(
        [(None, "X", 1), (7, "X", 2), (None, "Y", 3), (7, "X", 4), (7, "X", 4), (7, None, 5)],
        "doc_id long, text string, extra int",
    )
    kept = sorted(exact.without_copies(small).collect(), key=str)
    assert [r.text for r in kept if r.text is None] == [None] and len(kept) == 3
    assert sorted((r.text, r.doc_id) for r in kept if r.text == "X") == [("X", 7)]
    assert [r.doc_id for r in kept if r.text == "Y"] == [None]
    for rows in (docs, shared_ids):
        last = {}
        for r in rows.collect():
            place = (r.doc_id is not None, r.doc_id)
            last[r.text or ""] = max(last.get(r.text or "", place), place)
        found = exact.without_copies(rows).collect()
        assert len(found) == len(last) and set(found) <= set(rows.collect())
        assert {r.text or "": (r.doc_id is not None, r.doc_id) for r in found} == last


def test_near_copies_of_rows_that_share_ids(spark):
    near, other = PROSE + "and more", "something else entirely that stands alone in the table"
    rows = [(3, PROSE), (7, near), (7, other), (None, PROSE + "at last"), (None, other + " with much more text behind it")]
    rows += [(7, f"unlike number {i} of the seven " * 3) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {tuple(r) for r in minhash.without_near_copies(docs).collect()}
    gone = {(7, near), (None, PROSE + "at last")}
    assert kept >= {(3, PROSE), (7, other), (None, other + " with much more text behind it")} and not kept & gone


def test_long_texts_that_share_ids_are_named_one_by_one(spark):
    long = "word " * 9000
    rows = [(None, long + "a"), (None, long + "b"), (7, long + "a"), (7, long + "c"), (7, long + "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.text[-1], r.doc_id) for r in exact.without_copies(docs).collect())
    assert found == [("a", 7), ("b", None), ("c", 7)]


def test_mix_of_rows_that_share_ids(shared_ids):
    of_source, of_row = {}, {}
    rows = mixing.plan(shared_ids, carried=("n_chars",)).collect()
    for r in rows:
        of_source[r.source] = of_source.get(r.source, 0) + r.copies
        of_row[r.n_chars] = of_row.get(r.n_chars, 0) + r.copies
    found, taken = {}, {}
    for r in mixing.emit(shared_ids).collect():
        taken[r.source] = taken.get(r.source, 0) + 1
        found[r.n_chars] = found.get(r.n_chars, 0) + 1
    assert taken == {source: n for source, n in of_source.items() if n}
    words = {r.source: (r.target, r.size) for r in rows}
    for source, (target, size) in words.items():
        assert abs(taken.get(source, 0) * size - target) <= 2 * size


def test_rare_languages_are_trained(spark):
    rows = [(i, "the cat of the house", "en") for i in range(3000)]
    rows += [(3000 + i, "der hund und das haus", f"de{i // 20}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.train(docs, 20)[0] == ["de0", "de1", "de2", "de3", "de4", "en"]


def test_page_operators(pages):
    for work in (archive.archive_pages, html.extract):
        assert work(pages).count() == pages.count()
        assert work(pages.limit(0)).count() == 0


def test_stages(spark, docs):
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        if name == "mixing":
            assert rows.columns == docs.columns and rows.count() > 0
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        rows = stage(spark, rows, FOLDER).cache()
        rows.count()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_next_documents_of_wide_and_textual_ids(spark, monkeypatch, kind):
    ids = [-(2**63), 2**63 - 1, 0, 1, 2**62, -5, *range(10**15, 10**15 + 40), *range(60)]
    ids = sorted(set(ids if kind == "long" else map(str, ids)), reverse=True)
    texts = [f"text number {i} " * (1 + n % 3) for n, i in enumerate(ids)]
    monkeypatch.setattr(spots, "ROWS_PER_RANGE", 4)
    monkeypatch.setattr(spots, "STEP", 3)
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), f"doc_id {kind}, text string")
    found = {r.doc_id: r.edited_sha256 for r in spots.fingerprints(docs.repartition(3)).collect()}
    for i, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[(i + 1) % len(ids)][:half]
        assert found[doc_id] == hashlib.sha256(edited.encode()).hexdigest()
