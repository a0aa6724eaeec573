"""Best-fit packing of documents into sequences of equal capacity, online and with bounded space.

Each task packs the rows it reads. A fixed number of bins is open; a bitset has a bit for every free space that some
open bin has, so the fullest bin that still takes a piece is the lowest bit at or above the piece's length. If a piece
fits no open bin and no more may be opened, the fullest one closes. Pieces arrive in windows, longest first.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords
from .common import runs

CAPACITY = 1024
END = 2
OPEN_BINS = 2048
#: A window holds so many documents or characters at most (one document at least).
WINDOW_ROWS = 8192
WINDOW_CHARS = 6_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    """Open bins by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open, self.made = capacity, most, 0, 0
        self.free = 0  # bit f: some open bin has f places left
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset for a piece."""
        fit = self.free >> length
        if fit:
            space = length + (fit & -fit).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            number, space = self.made, self.capacity
            self.made += 1
        left = space - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - space


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document number, piece number, start and length of all pieces: full ones, after a first one with the rest."""
    count = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = (lengths - (count - 1) * capacity)[doc]
    start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, first, capacity)


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    end: int = END,
    open_bins: int = OPEN_BINS,
    vocabulary: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids``.

    ``ids_crc32`` is the CRC-32 of the ids as unsigned little-endian 32-bit numbers; ``with_ids=False`` leaves the ids
    themselves in the task.

    A null text is empty; every document has at least its end id. Repeated rows are packed each; other columns are left
    out. A sequence holds documents of one partition, so its number is the partition's and a running one, and a task
    that runs again gives the same rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(subwords.vocabulary_bytes(vocabulary))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords.text_encoder(shared.value).encode
        bins = OpenBins(capacity, open_bins)
        task = TaskContext.get().partitionId() << 32
        for keys, texts in windows(batches):
            ids, begin = encode(texts)
            ids = np.insert(ids, begin[1:], end)
            begin = begin + np.arange(len(begin))
            doc, piece, start, length = cut(np.diff(begin), capacity)
            bin_, offset = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
            for i in np.argsort(-length, kind="stable").tolist():
                bin_[i], offset[i] = bins.place(int(length[i]))
            bounds = np.append(begin[doc] + start, len(ids))  # pieces lie in the order of the ids
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in itertools.pairwise(bounds.tolist())]
            columns = [
                keys.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(task + bin_), pa.array(offset),
            ]
            if with_ids:
                flat = pa.array(ids.astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECES + ", ids array<int>" * with_ids
    names = [part.split()[0] for part in schema.split(", ")]
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(place, schema)


def windows(batches: Iterator[pa.RecordBatch], chars: int = WINDOW_CHARS, most: int = WINDOW_ROWS) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of the partition in windows."""
    keys: list[pa.Array] = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        found = [t or "" for t in batch.column(1).to_pylist()]
        for part in runs(found, chars, most):
            some = found[part]
            size = sum(map(len, some))
            if texts and (held + size > chars or len(texts) + len(some) > most):
                yield pa.concat_arrays(keys), texts
                keys, texts, held = [], [], 0
            keys.append(batch.column(0)[part])
            texts = texts + some
            held += size
    if texts:
        yield pa.concat_arrays(keys), texts
