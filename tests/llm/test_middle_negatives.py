"""Fill-in-middle and hard negatives against brute force and the SQL beside the queries."""

import hashlib
import random
import re

import numpy as np
import pytest
import zstandard

from ledgerlake.llm import middle, negatives
from ledgerlake.llm.queries import ORACLES, QUERIES
from tools.check_sql import _rows, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_middle", "op13_negatives"])
def test_queries_match_sql(spark, name):
    found = QUERIES[name](spark, FOLDER)
    expected = connect(FOLDER).execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(found.columns)
    rows = found.select(*names)
    assert _rows(names, map(tuple, rows.collect())) == _rows(names, expected.fetchall())


def plain_middle(doc_id, text):
    """Form, lengths, output as the contract words it."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    name = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    letters = ["a", "B", "z", " ", "\n", "é", "漢", "\U0001f600", "<", "P", ">", "<S", "1"]
    rows = [(i, "".join(draw.choices(letters, k=draw.randrange(40)))) for i in range(400)]
    rows += [(1000 + i, "x" * i) for i in range(30)]  # one unit over several frames
    rows += [(1100 + i, "abc" * 7 + " " * i + "yz" * 9) for i in range(20)]
    rows += [(None, None), (None, "some text"), (1200, None), (1201, ""), (1202, "a <M> b")]
    rows += [(1203, "repeated row"), (1203, "repeated row"), (1204, "<P"), (1205, "<S><")]
    return rows


@pytest.mark.parametrize("size", [1, 4, 7, middle.FRAME])
def test_middle_in_frames_of_any_size(spark, texts, size):
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' as form", "7 as n")
    made = middle.transformed(docs, size)
    rows = made.collect()
    found = []
    for r in rows:
        joined = b"".join(bytes(f) for f in r.output)
        reader = zstandard.ZstdDecompressor().stream_reader(joined, read_across_frames=True)
        output = reader.read()
        assert output == b"".join(middle.raw(bytes(f)) for f in r.output)
        back = b"".join(middle.restored([bytes(f) for f in r.output], r.form)).decode()
        found.append((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, output.decode(), back))
    expected = [(i, *plain_middle(i, t), t or "") for i, t in texts]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    digests = {
        (r.doc_id, r.output_sha256, r.restored_sha256) for r in middle.with_digests(made).collect()
    }
    assert digests == {
        (i, *(hashlib.sha256(x.encode()).hexdigest() for x in (out, back)))
        for i, *_, out, back in expected
    }


def test_only_frames_with_a_cut_are_read():
    text = "".join(f"word{i} " for i in range(5000))
    frames, n = middle.frames_of(text, 1000)
    held = middle.Framed(frames, n, len(text))
    a, b = held.place(n // 3), held.place(n // 2)
    list(held.between(0, a)), list(held.between(a, b)), list(held.between(b, len(text)))
    assert len(held.read) <= 2 < len(frames)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert n == len(units) and a == len("".join(units[: n // 3]))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert middle.with_digests(middle.transformed(docs)).count() == 0


def plain_negatives(rows, every=100):
    """The contract row by row, in Python integers."""
    usable = {}
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        v = tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)
        if sum(x * x for x in v) >= 2**62:
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable[(vec_id, label, v)] = None
    out = []

    def order(vec_id, score):
        return (-score, vec_id is None, vec_id or 0)

    for anchor in usable:
        if anchor[0] is None or anchor[0] % every:
            continue
        scored = [
            (row, sum(x * y for x, y in zip(anchor[2], row[2], strict=False)))
            for row in usable
            if row != anchor
        ]
        same = sorted((order(r[0], s), r[0], s) for r, s in scored if r[1] == anchor[1])
        for _, positive, p in same[:5]:
            fit = [(r[0], s) for r, s in scored if r[1] != anchor[1] and 80 * p <= 100 * s <= 100 * p]
            fit.sort(key=lambda x: order(*x))
            out += [
                (anchor[0], positive, i + 1, negative, p, s)
                for i, (negative, s) in enumerate(fit[:5])
            ]
    return sorted(out, key=str)


def test_negatives_of_odd_rows(spark):
    draw = np.random.Generator(np.random.PCG64(3))
    centres = draw.standard_normal((6, 20))
    rows = []
    for i in range(900):
        v = centres[i % 6] + 0.7 * draw.standard_normal(20)
        rows.append((i, [float(np.float32(x)) for x in v], int(draw.integers(0, 4))))
    same = rows[5][1]
    rows += [(2000 + i, same, i % 3) for i in range(40)]  # ties
    rows += [(100, same, 1), (100, same, 1), (100, same, 2), (None, same, 1), (None, rows[6][1], 2)]
    rows += [(3000, None, 1), (3001, same, None), (3002, [], 1), (3003, [1.0, None], 1)]
    rows += [(3004, [float("nan")] * 20, 1), (3005, [float("inf")] * 20, 1), (3006, same[:7], 1)]
    rows += [(3007, [1e30] * 20, 1), (3100, [0.0] * 20, 1), (3200, [-x for x in same], 2)]
    rows += [(3300, [*same, 9.0, -9.0], 1), (3400, [1e6] * 20, 2), (4000, same, 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame = frame.selectExpr("*", "1 as key", "'x' as bits", "2 as across", "3 as rank")
    found = negatives.hard_negatives(frame).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_negatives(rows)
    assert negatives.hard_negatives(frame.limit(0)).count() == 0
    assert negatives.hard_negatives(frame.where("vec_id % 100 <> 0")).count() == 0


def test_negatives_count_repeated_rows(spark, tmp_path, monkeypatch):
    """Rows that are there several times are as many rows: the query's contract by index."""
    draw = np.random.Generator(np.random.PCG64(8))
    centres = draw.standard_normal((3, 12))
    rows = []
    for i in range(500):
        v = centres[i % 3] + 0.6 * draw.standard_normal(12)
        rows.append((i, [float(np.float32(x)) for x in v], int(draw.integers(0, 3))))
    rows += [rows[i] for i in range(500) if i % 5 == 0 for _ in range(1 + i % 3)]  # anchors too
    rows += [rows[7]] * 9
    path = f"{tmp_path}/embeddings.parquet"
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.write.parquet(path)
    monkeypatch.setattr(negatives, "ROWS_PER_BLOCK", 128)
    found = QUERIES["op13_negatives"](spark, str(tmp_path))

    vectors = np.array([np.floor(256 * np.array(v)) for _, v, _ in rows]).astype(np.int64)
    labels = [(n + 1) % 10 if i % 7 == 0 else n for i, _, n in rows]
    expected = []
    for a, (anchor, _, _) in enumerate(rows):
        if anchor % 100:
            continue
        scores = (vectors @ vectors[a]).tolist()
        order = sorted((-scores[j], rows[j][0], j) for j in range(len(rows)) if j != a)
        positives = [j for *_, j in order if labels[j] == labels[a]][:5]
        for j in positives:
            fit = [
                k
                for *_, k in order
                if labels[k] != labels[a] and 80 * scores[j] <= 100 * scores[k] <= 100 * scores[j]
            ]
            expected += [
                (anchor, rows[j][0], n + 1, rows[k][0], scores[j], scores[k])
                for n, k in enumerate(fit[:5])
            ]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert len(set(expected)) < len(expected)


def test_blocks_change_nothing(spark, monkeypatch):
    draw = np.random.Generator(np.random.PCG64(4))
    rows = [(i, [float(x) for x in draw.standard_normal(70)], i % 2) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(negatives, "ROWS_PER_BLOCK", 97)
    monkeypatch.setattr(negatives, "ANCHORS_PER_BLOCK", 2)
    found = negatives.hard_negatives(frame).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_negatives(rows)


def test_intervals_hold_the_score():
    draw = np.random.Generator(np.random.PCG64(6))
    vectors = draw.integers(-300, 300, (500, 128)).astype(np.int32)
    vectors[3] = 0
    bits, aligned, left = negatives.codes_of(vectors)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    for q in (vectors[0], vectors[3], vectors[1] // 7):
        asked, exact = negatives.Asked.of(q), vectors.astype(np.int64) @ q.astype(np.int64)
        score, fuzz, widths = np.zeros(500), np.zeros(500), []
        for level in range(negatives.LEVELS):
            product = asked.product(level, bits[:, level], 128)
            score, fuzz = score + aligned[:, level] * product, fuzz + aligned[:, level] * asked.off[level]
            along = np.maximum(0, np.abs(product) - asked.off[level])
            wide = fuzz + left[:, level] * np.sqrt(np.maximum(0, asked.length**2 - along**2))
            assert (np.abs(score - exact) <= wide + 1e-9 * asked.length * lengths).all()
            widths.append(wide.sum())
        assert widths == sorted(widths, reverse=True)
