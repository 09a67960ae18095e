"""Fill-in-middle examples from seekable compressed texts.

A text is stored as frames: independent zstandard frames of FRAME code points each, with
the units and code points that lie before each. A unit is a run of A-Z and a-z, or any
other single code point; a run that goes on in the next frame is counted where it begins.
The cumulative counts lead from a cut, which is a number of units, to the one frame it
lies in; only that frame is decompressed to find the place and split it. Every other
frame goes into the output as it is, without being read. Frames in order are one valid
zstandard stream, so an output is a list of frames too; digests stream it frame by frame.

Form and cuts come from a digest of the doc_id alone, so reruns and copies agree.

Defined cases: a null text is empty; an empty text, or one that holds a marker, stays
plain, whatever its id says. A null doc_id is hashed as no digits. Rows are answered one
by one: repeated rows repeat, an empty table gives no rows, and other columns than doc_id
and text are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import python_workers, stored, whole

FRAME = 1 << 16  # code points
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100
SUFFIX_FIRST_BELOW = 20  # of 100
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


@lru_cache(maxsize=1)
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@lru_cache(maxsize=1)
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def packed(text: str) -> bytes:
    return _packer().compress(text.encode("utf-8", "surrogatepass"))


def raw(frame: bytes) -> bytes:
    return _unpacker().decompress(frame)


def unpacked(frame: bytes) -> str:
    return raw(frame).decode("utf-8", "surrogatepass")


def unit_starts(text: str, inside: bool = False) -> np.ndarray:
    """The places where units begin; ``inside`` if a letter precedes the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lower = points | 0x20
    letter = (lower >= ord("a")) & (lower <= ord("z")) & (points < 128)
    before = np.concatenate([[inside], letter[:-1]]) if len(letter) else letter
    return np.flatnonzero(~(letter & before))


def is_letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def frames_of(text: str, size: int = FRAME) -> tuple[list[tuple[int, int, bytes]], int]:
    """(units before, code points before, data) of every frame, and the number of units."""
    frames, units = [], 0
    for at in range(0, len(text), size):
        part = text[at : at + size]
        frames.append((units, at, packed(part)))
        units += len(unit_starts(part, at > 0 and is_letter(text[at - 1])))
    return frames, units


class Framed:
    """A stored text: its frames, with code points and units in all."""

    def __init__(self, frames: list[tuple[int, int, bytes]], units: int, chars: int):
        self.units = [f[0] for f in frames] + [units]
        self.chars = [f[1] for f in frames] + [chars]
        self.data = [f[2] for f in frames]
        self.read: dict[int, str] = {}

    def frame(self, i: int) -> str:
        if i not in self.read:
            self.read[i] = unpacked(self.data[i])
        return self.read[i]

    def place(self, units: int) -> int:
        """How many code points the first units take."""
        if units >= self.units[-1]:
            return self.chars[-1]
        i = bisect_right(self.units, units) - 1
        starts = unit_starts(self.frame(i))
        # one start too many: the frame begins within a unit of the frame before
        begun = len(starts) - (self.units[i + 1] - self.units[i])
        return self.chars[i] + int(starts[begun + units - self.units[i]])

    def between(self, start: int, end: int) -> Iterator[bytes]:
        """The code points from start to end as frames, whole ones unread."""
        i = bisect_right(self.chars, start) - 1
        while start < end:
            first, after = self.chars[i], self.chars[i + 1]
            stop = min(end, after)
            if (start, stop) == (first, after):
                yield self.data[i]
            else:
                yield packed(self.frame(i)[start - first : stop - first])
            start, i = stop, i + 1


def framed(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """Per row: doc_id, n (units), chars, marked (holds a marker) and frames."""
    python_workers(docs.sparkSession)
    shape = pa.list_(
        pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
    )

    def read(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            made = [frames_of(text, size) for text in texts]
            rows = [
                [{"units": u, "chars": c, "data": d} for u, c, d in frames] for frames, _ in made
            ]
            marked = [any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for _, n in made], pa.int64()),
                    pa.array([len(text) for text in texts], pa.int64()),
                    pa.array(marked, pa.bool_()),
                    pa.array(rows, shape),
                ],
                names=["doc_id", "n", "chars", "marked", "frames"],
            )

    return docs.select(F.col("doc_id").cast("long"), whole("text").alias("text")).mapInArrow(
        read,
        "doc_id long, n long, chars long, marked boolean, "
        "frames array<struct<units:long,chars:long,data:binary>>",
    )


def drawn(nth: int) -> Column:
    """The nth 8-digit group of the document's digest as a number."""
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(name, 8 * nth - 7, 8), 16, 10).cast("long")


def chosen(frames: DataFrame) -> DataFrame:
    """Adds form and the units before the middle and before the suffix (first, second)."""
    one, two = (F.pmod(drawn(i), F.col("n") + 1) for i in (1, 2))
    plain = (F.col("n") == 0) | F.col("marked") | (drawn(3) % 100 >= PLAIN_FROM)
    return frames.select(
        "*",
        F.when(plain, "plain")
        .when(drawn(4) % 100 < SUFFIX_FIRST_BELOW, "spm")
        .otherwise("psm")
        .alias("form"),
        F.least(one, two).alias("first"),
        F.greatest(one, two).alias("second"),
    )


def transformed(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars and output, a list of frames."""

    def rearrange(batches):
        for batch in batches:
            outputs, prefixes, middles = [], [], []
            for row in batch.to_pylist():
                text = Framed([tuple(f.values()) for f in row["frames"]], row["n"], row["chars"])
                if row["form"] == "plain":
                    outputs.append(text.data)
                    prefixes.append(None)
                    middles.append(None)
                    continue
                a, b = text.place(row["first"]), text.place(row["second"])
                spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, row["chars"])}
                output = []
                for marker in ORDER[row["form"]]:
                    output.append(packed(marker))
                    output += text.between(*spans[marker])
                outputs.append(output)
                prefixes.append(a)
                middles.append(b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "n", "form")),
                    pa.array(prefixes, pa.int64()),
                    pa.array(middles, pa.int64()),
                    pa.array(outputs, pa.list_(pa.binary())),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return chosen(stored(framed(docs, size), "middle-frames")).mapInArrow(
        rearrange,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
        "output array<binary>",
    )


def pieces(output: Iterable[bytes], form: str) -> Iterator[tuple[str, bytes]]:
    """What an output's frames hold behind each marker, in parts (marker, bytes)."""
    order, at, left = [m.encode() for m in ORDER[form]], -1, b""
    for frame in output:
        left += raw(frame)
        while at < 2:
            found = left.find(order[at + 1])
            if found < 0:
                break
            if at >= 0:
                yield ORDER[form][at], left[:found]
            at, left = at + 1, left[found + 3 :]
        keep = 0 if at == 2 else 2  # a marker may go on in the next frame
        if at >= 0 and len(left) > keep:
            yield ORDER[form][at], left[: len(left) - keep]
            left = left[len(left) - keep :]
    yield ORDER[form][at], left


def restored(output: list[bytes], form: str) -> Iterator[bytes]:
    """The document again, in parts, from output and form alone."""
    if form == "plain":
        yield from map(raw, output)
        return
    for wanted in (PREFIX, MIDDLE, SUFFIX):
        for marker, part in pieces(output, form):
            if marker == wanted:
                yield part


def streamed_digest(parts: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def with_digests(rows: DataFrame) -> DataFrame:
    """The rows with digests of output and restored text in the place of the output."""

    def digest(batches):
        for batch in batches:
            outputs = batch.column("output").to_pylist()
            forms = batch.column("form").to_pylist()
            made = [streamed_digest(map(raw, output)) for output in outputs]
            again = [
                streamed_digest(restored(o, f)) for o, f in zip(outputs, forms, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(made, pa.string()), pa.array(again, pa.string())],
                names=[*batch.schema.names[:5], "output_sha256", "restored_sha256"],
            )

    return rows.mapInArrow(
        digest,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
        "output_sha256 string, restored_sha256 string",
    )
