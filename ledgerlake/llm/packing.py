"""Best-fit packing by exact-complement hashing.

Documents are tokenised and cut where they are longer than a sequence; the pieces'
lengths are counted. There are at most SEQUENCE different lengths, so the counts, and
what is decided from them, stay small however many pieces there are. From the longest
length down, the gap a piece leaves is looked up in the indexes of single, pair and
triple length sums, and a combination that fills it exactly is used as often as the
counts of its lengths allow. What has no exact complement goes best-fit into the open
sequences, or opens new ones. The decisions are runs: "the pieces ranked r to r+n of
length l stand in sequences s to s+n at offset o". Spark ranks the pieces of each
length and every piece finds its run by binary search.

Defined cases: a null text is empty; an empty document is one piece, its end id. Rows
that repeat a doc_id are packed each. An empty table gives no rows. Other columns than
doc_id and text are not read. Special-token strings in a text count as the tokenizer
itself treats them.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import python_workers, stored, whole

SEQUENCE = 4096
END_ID = 1
SALTS = 64
VOCABULARY = "word_bpe_49k.json"
#: Punctuation that is a piece of its own after a word; no apostrophe, which starts suffixes.
MARKS = '.,;:!?%$#&*|()"/+=<>[]{}~^@-'
CACHE = 500_000


class Encoder(dict):
    """Ids, as bytes, of the parts of a text between spaces, kept while a worker lives.

    The tokenizer's steps never look across white space, so a text's ids are those of
    its parts. A part that is a lower-case word with marks behind it goes to the BPE
    model directly; any other goes through the whole tokenizer.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: 256 + i for i, b in enumerate(hidden)}  # byte-level spelling

    def piece(self, text: str) -> list[int]:
        if not text:
            return []
        spelled = text.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(spelled)]

    def __missing__(self, part: str) -> bytes:
        word = part.rstrip(MARKS)
        if not word or word.isalpha():
            ids = self.piece(word) + self.piece(part[len(word) :])
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        if len(self) >= CACHE:
            self.clear()
        self[part] = found = array("I", ids).tobytes()
        return found

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        # special tokens, and letters whose lower case depends on their place or changes length
        odd = "<|" in text or "Σ" in text or "İ" in text
        if odd or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return array("I", ids).tobytes()
        spaced = text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.__getitem__, spaced.split(" ")))


_encoders: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """One per worker process; its cache serves all tasks the worker runs."""
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]


def vocabulary_file(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, name: str = VOCABULARY, size: int = SEQUENCE) -> DataFrame:
    """Per piece of each document: doc_id, piece, start, length, ids_crc32."""
    python_workers(docs.sparkSession)

    def cut(batches):
        encode, end = encoder(vocabulary_file(name)).encode, array("I", [END_ID]).tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) + end
                for at in range(0, len(ids), 4 * size):
                    part = ids[at : at + 4 * size]
                    place = at // (4 * size)
                    out.append((doc_id, place, place * size, len(part) // 4, zlib.crc32(part)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), whole("text").alias("text")).mapInPandas(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def exact_filling(
    have: np.ndarray, sums: np.ndarray, gap: int, parts: int
) -> tuple[int, ...] | None:
    """That many available lengths, one to three, that sum to the gap, the largest first.

    ``sums[s]`` says that some pair summed to s when the index was made; availability
    only falls, so a stale entry is found out here and struck off.
    """

    def pair(total: int) -> tuple[int, int] | None:
        if total < 2 or not sums[total]:
            return None
        a = np.arange(total - 1, (total - 1) // 2, -1)
        good = (have[a] > 0) & (have[total - a] > 0) & ((2 * a != total) | (have[a] > 1))
        if not good.any():
            sums[total] = False
            return None
        first = int(a[np.argmax(good)])
        return first, total - first

    if parts == 1:
        return (gap,) if have[gap] > 0 else None
    if parts == 2:
        return pair(gap)
    a = np.arange(gap - 2, 0, -1)
    for first in a[(have[a] > 0) & sums[gap - a]]:
        have[first] -= 1
        rest = pair(gap - int(first))
        have[first] += 1
        if rest:
            return (int(first), *rest)
        sums[gap - int(first)] |= bool(have[first] == 1)  # struck off for this piece's sake only
    return None


def pack(counts: dict[int, int], size: int = SEQUENCE) -> tuple[np.ndarray, int]:
    """The best of a few orders, by the number of sequences: exact fillings of up to three,
    two, one and no other lengths before the rest goes by best fit. All from the counts."""
    return min((filled(counts, size, most) for most in (3, 2, 1, 0)), key=lambda made: made[1])


def filled(
    counts: dict[int, int], size: int = SEQUENCE, most: int = 3
) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, count, first sequence, offset) for counted lengths, and
    the number of sequences. Work and result depend on the number of lengths only.

    All lengths are filled up by single ones first, then by pairs, then by triples: short
    pieces are not spent on a long one while another long one has a complement of its own.
    """
    have = np.zeros(size + 1, dtype=np.int64)
    for length, count in counts.items():
        have[length] = count
    there = (have > 0).astype(float)
    sums = np.convolve(there, there)[: size + 1] > 0.5
    used = np.zeros(size + 1, dtype=np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, int(used[length]), count, sequence, offset))
        used[length] += count
        have[length] -= count

    def open_with(lengths, count: int) -> int:
        nonlocal sequences
        offset = 0
        for length in lengths:
            put(length, count, sequences, offset)
            offset += length
        sequences += count
        return offset

    if have[size]:
        open_with((size,), int(have[size]))
    for parts in range(1, most + 1):
        for length in range(size - 1, 0, -1):
            while have[length] > 0:
                have[length] -= 1
                rest = exact_filling(have, sums, size - length, parts)
                have[length] += 1
                if not rest:
                    break
                needed = Counter((length, *rest))
                open_with((length, *rest), min(int(have[x]) // n for x, n in needed.items()))

    open_gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of open sequences
    gaps = np.zeros(size + 1, dtype=bool)

    def leave(gap: int, sequence: int, count: int) -> None:
        if gap and count:
            open_gaps.setdefault(gap, []).append((sequence, count))
            gaps[gap] = True

    for length in range(size - 1, 0, -1):
        while have[length] > 0:
            fitting = np.flatnonzero(gaps[length:])
            if len(fitting):
                gap = length + int(fitting[0])
                sequence, count = open_gaps[gap].pop()
                gaps[gap] = bool(open_gaps[gap])
                taken = min(count, int(have[length]))
                put(length, taken, sequence, size - gap)
                leave(gap - length, sequence, taken)
                leave(gap, sequence + taken, count - taken)
            else:
                each = min(size // length, int(have[length]))
                count = int(have[length]) // each
                first = sequences
                leave(size - open_with((length,) * each, count), first, count)
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    return table, sequences


def packed(cut: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Give every piece of a stored table of pieces its sequence_id and offset."""
    spark = cut.sparkSession
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    runs, _ = pack(counts, size)
    shared = spark.sparkContext.broadcast(runs)

    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    along = Window.partitionBy("length").orderBy("salt")
    cells = stored(
        salted.groupBy("length", "salt")
        .count()
        .select("length", "salt", (F.sum("count").over(along) - F.col("count")).alias("before")),
        "pack-cells",
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("place", F.row_number().over(inside))
        .join(cells, ["length", "salt"])
        .select(*cut.columns, (F.col("before") + F.col("place") - 1).alias("rank"))
    )

    def assign(batches):
        table = shared.value
        starts = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            run = np.searchsorted(starts, length << 48 | rank, side="right") - 1
            batch["sequence_id"] = table[run, 3] + rank - table[run, 1]
            batch["offset"] = table[run, 4]
            yield batch.drop(columns="rank").astype({"doc_id": "Int64"})

    return ranked.mapInPandas(
        assign,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame, name: str = VOCABULARY, size: int = SEQUENCE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed(stored(pieces(docs, name, size), "pack-pieces"), size)
