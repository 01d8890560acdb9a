"""Harmonic packing of tokenised documents into sequences.

A class holds the pieces of which exactly ``k`` fit a sequence: lengths in
``(capacity / (k + 1), capacity / k]``. Every worker fills each class's sequences
with ``k`` pieces on its own, so no row is moved to pack it. A length that would
leave much of its share empty is first cut: its head gets exactly the greatest
length of a class, the rest goes on as a shorter piece.

What a worker is left with is less than one sequence a class, a number that the
classes bound whatever the input. These leftovers, as numbers only, meet in a
tree of a fixed fan-in: eight workers' leftovers fill sequences together, and so
on until one group remains, which packs its rest best fit first.
"""

import math
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retail_lake.llm.common import renamed, stored, table
from retail_lake.llm.segments import SegmentEncoder

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
#: Closes every document.
END_ID = 1
#: Share of a sequence that a class may leave empty before its pieces are cut.
SLACK = 1 / 64
#: Shorter pieces are never cut, and cutting leaves none below half of it if it can help it.
WHOLE = 128
#: Workers whose leftovers meet in one group.
FAN_IN = 8

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PLACED = f"{PIECE}, worker bigint, sequence_id bigint, offset bigint"
_NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")


@lru_cache(maxsize=2)
def encoder(path: str) -> SegmentEncoder:
    """The tokenizers library behind the segment encoder. Strings of special tokens
    count as ordinary text."""
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    widths = np.zeros(library.get_vocab_size(), np.int64)
    for token, number in library.get_vocab(with_added_tokens=False).items():
        widths[number] = len(token)  # one character stands for each byte
    return SegmentEncoder(lambda text: library.encode_batch_fast([text], add_special_tokens=False)[0].ids, widths)


@lru_cache(maxsize=1 << 16)
def cuts(length: int, capacity: int = CAPACITY) -> tuple[int, ...]:
    """Lengths of the pieces of the rest of a document, shorter than a sequence."""
    out = []
    while length >= WHOLE:
        k = capacity // length
        if capacity - k * length <= SLACK * capacity:
            break
        head = capacity // (k + 1)
        if 0 < length - head < WHOLE // 2:
            head = capacity // (k + 2)
        out.append(head)
        length -= head
    return (*out, length) if length else tuple(out)


def lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    return [capacity] * (tokens // capacity) + list(cuts(tokens % capacity, capacity))


class Bins:
    """Open sequences of one worker, a list of pieces for each class."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.placed: list[tuple] = []

    def add(self, piece: tuple) -> None:
        """``piece``: the columns of PIECE. A full sequence is placed at once."""
        k = self.capacity // piece[2]
        self.open[k].append(piece)
        if len(self.open[k]) == k:
            self.place(self.open.pop(k))

    def place(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.placed.append((*piece, None, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1

    def leftovers(self) -> list[tuple]:
        return [piece for k in sorted(self.open) for piece in self.open[k]]

    def best_fit(self) -> None:
        """Place all that is left: longest first, each where it leaves least room."""
        room: list[tuple[int, int]] = []
        content: list[list[tuple]] = []
        for piece in sorted(self.leftovers(), key=lambda p: -p[2]):
            at = bisect_left(room, (piece[2], -1))
            if at < len(room):
                left, n = room.pop(at)
            else:
                left, n = self.capacity, len(content)
                content.append([])
            content[n].append(piece)
            if left > piece[2]:
                insort(room, (left - piece[2], n))
        self.open.clear()
        for pieces in content:
            self.place(pieces)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = (*_NAMES, "worker", "sequence_id", "offset")
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


def _sequence_base(level: int, group: int) -> int:
    """Sequence numbers of a group at a level of the tree: disjoint, 2^28 for each."""
    return (level << 58) | (group << 28)


def fill(batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Tokenise, cut and place the documents of one worker; rows without a
    ``sequence_id`` are its leftovers."""
    worker = TaskContext.get().partitionId()
    bins, ids_of = Bins(capacity, _sequence_base(0, worker)), encoder(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        keys = batch.column("doc_id")
        for first, last, offsets, ids in ids_of.column(batch.column("text")):
            flat = ids.astype("<u4", copy=False).tobytes()
            bounds = offsets.tolist()
            for key, a, b in zip(keys.slice(first, last - first).to_pylist(), bounds, bounds[1:], strict=False):
                document, start = flat[4 * a : 4 * b] + end, 0
                for n in lengths(b - a + 1, capacity):
                    crc = zlib.crc32(document[4 * start : 4 * (start + n)])
                    bins.add((key, start, n, crc, b - a + 1))
                    start += n
            if bins.placed:
                yield _batch(bins.placed)
                bins.placed = []
    yield _batch([(*piece, worker, None, None) for piece in bins.leftovers()])


def _refill(level: int, last: bool, capacity: int):
    """Place the leftovers of a group of workers; at the last level, all of them."""

    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        bins = Bins(capacity, _sequence_base(level, group))
        pieces = zip(*(rows.column(n).to_pylist() for n in _NAMES), strict=True)
        for piece in sorted(pieces, key=lambda p: (p[0] is None, p[0] or 0, *p[1:])):
            bins.add(piece)
        if last:
            bins.best_fit()
        left = [(*piece, group, None, None) for piece in bins.leftovers()]
        return pa.Table.from_batches([_batch(bins.placed + left)])

    return run


def pack(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of the documents ``(doc_id, text)``: where it lies in its
    document (``start``, ``length`` of ``doc_tokens`` ids, the end id included), the
    CRC-32 of its ids, and where it lies in its sequence.

    Every document, one without text too, has at least its end id. Documents of a
    repeated or NULL ``doc_id`` are packed each on its own. Other columns are not
    read. An empty table gives no rows.
    """
    docs = renamed(df, doc_id="doc_id", text="text")
    placed = stored(
        docs.mapInArrow(lambda batches: fill(batches, tokenizer, capacity, end_id), PLACED), "packing"
    )
    done = [placed.where(F.col("sequence_id").isNotNull())]
    left = placed.where(F.col("sequence_id").isNull())
    workers = (left.agg(F.max("worker")).first()[0] or 0) + 1
    level = 0
    while True:
        level, workers = level + 1, math.ceil(workers / FAN_IN)
        grouped = left.groupBy(F.floor(F.col("worker") / FAN_IN).cast("bigint").alias("group"))
        placed = stored(grouped.applyInArrow(_refill(level, workers == 1, capacity), PLACED), "packing")
        done.append(placed.where(F.col("sequence_id").isNotNull()))
        if workers == 1:
            break
        left = placed.where(F.col("sequence_id").isNull())
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("worker")


def default_tokenizer() -> str:
    return public_tokenizers.path(TOKENIZER)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
