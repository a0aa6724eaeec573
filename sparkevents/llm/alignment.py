"""Alignment of two tokenizers' tokens by coalescing their byte intervals, and how often the corpus links two ids.

All tokens of both sides are sorted by where they start; the running maximum of their ends shows where a token starts
beyond all before it, and there a group ends. Within a group the overlaps expand to pairs, of which those that end
together are links.

Texts are cut where both sides surely end a token, and every distinct stretch is aligned once by a worker. The corpus's
counts of linked ids come from the distinct pairs of chunks of texts, and go back to the chunks in the same form, so the
shuffles never hold a row per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import pieces, subwords
from .common import materialize
from .packing import windows

#: Distinct stretches whose alignment a worker remembers; beyond it, it starts again.
REMEMBERED = 300_000
#: Stretches aligned at a time, and characters in a chunk (one text at least).
STRETCHES, CHUNK_CHARS = 20_000, 4_000_000


def coalesced(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of overlapping intervals, none of them empty: the order of the intervals by start, and for each interval in
    that order the number of its group."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = start[order][1:] >= reach[:-1]
    return order, np.cumsum(fresh) - 1


def overlaps(order: np.ndarray, group: np.ndarray, side: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple:
    """All pairs of an interval of side 0 and one of side 1 that overlap; the intervals of a side don't overlap.

    An interval of side 0 meets a run of those of side 1, found by their borders; only these pairs are made.
    """
    a, b = order[side[order] == 0], order[side[order] == 1]
    first = np.searchsorted(end[b], start[a], "right")
    last = np.searchsorted(start[b], end[a], "left")
    count = np.maximum(last - first, 0)
    left = np.repeat(a, count)
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return left, b[np.repeat(first, count) + place]


class Sides:
    """The two tokenizers of a worker."""

    def __init__(self, vocabulary: bytes, model: pieces.Vocabulary):
        self.a, self.b = subwords.TextEncoder(vocabulary), pieces.PieceEncoder(model)
        shown = pieces.Decoder(model)
        self.b_size, self.b_flat = shown.size, shown.flat
        flat = self.a.token_bytes()
        self.a_size = np.array([len(x) for x in flat], np.int64)
        self.a_flat = np.frombuffer(b"".join(flat), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Known stretches by number, with the texts of their groups, their links and whether both sides spell them."""
        self.known: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.sums = np.zeros((4, 0), np.int32)  # tokens of a side, groups, whether the bytes are the stretch's
        self.links, self.n_links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, found: list[bytes]) -> np.ndarray:
        """The stretches' numbers; new ones are aligned first."""
        if len(self.known) > REMEMBERED:
            self.forget()
        numbers = list(map(self.known.get, found))
        new = list(dict.fromkeys(x for x, n in zip(found, numbers, strict=True) if n is None))
        for i in range(0, len(new), STRETCHES):
            self.align(new[i : i + STRETCHES])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        numbers = [self.known[x] if n is None else n for x, n in zip(found, numbers, strict=True)]
        return np.array(numbers, np.int64)

    def align(self, new: list[bytes]) -> None:
        lists = (self.a.plain(new), self.b.spell(new))
        ids = [np.fromiter((i for x in side for i in x), np.int64) for side in lists]
        sizes = [np.array([len(x) for x in side], np.int64) for side in lists]
        lengths = [self.a_size[ids[0]], self.b_size[ids[1]]]
        # a stretch that one side spells otherwise has no tokens
        whole = np.frombuffer(b"".join(new), np.uint8)
        own = np.array([len(x) for x in new], np.int64)
        good = np.ones(len(new), bool)
        for flat, size, side, n in zip((self.a_flat, self.b_flat), (self.a_size, self.b_size), ids, sizes, strict=True):
            spelt, ends = subwords.gathered(flat, size, side)
            bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n)))]
            if len(spelt) != len(whole) or (np.diff(bounds) != own).any() or (spelt != whole).any():
                text = spelt.tobytes()
                for i, stretch in enumerate(new):
                    good[i] &= text[bounds[i] : bounds[i + 1]] == stretch
        of = [np.repeat(np.arange(len(new)), n) for n in sizes]
        kept = [good[x] for x in of]
        ids, of, lengths = ([x[k] for x, k in zip(part, kept, strict=True)] for part in (ids, of, lengths))
        # places of all tokens, one stretch after the other
        end = np.concatenate([np.cumsum(n) for n in lengths])
        start = end - np.concatenate(lengths)
        side = np.repeat([0, 1], [len(x) for x in ids])
        every, stretch = np.concatenate(ids), np.concatenate(of)
        order, group = coalesced(start, end)
        left, right = overlaps(order, group, side, start, end)
        together = end[left] == end[right]
        links = every[left[together]] << 32 | every[right[together]]
        count = np.bincount(stretch[left[together]], minlength=len(new))
        n_groups = np.bincount(stretch[order][np.flatnonzero(np.diff(group, prepend=-1))], minlength=len(new))
        tokens = [np.bincount(x, minlength=len(new)) for x in of]
        self.sums = np.concatenate((self.sums, np.array([*tokens, n_groups, good], np.int32)), axis=1)
        self.links, self.n_links = np.append(self.links, links), np.append(self.n_links, count.astype(np.int32))
        self.groups += group_texts(order, group, side, every, stretch, len(new))


def group_texts(
    order: np.ndarray, group: np.ndarray, side: np.ndarray, ids: np.ndarray, stretch: np.ndarray, count: int
) -> list[str]:
    """``a1,a2|b1;a3|b2`` for every stretch, empty without tokens."""
    by = order[np.lexsort((np.arange(len(order)), side[order], group))]  # within a group side 0 first
    numbers, sides, texts = group, side[by], list(map(str, ids[by].tolist()))
    before = np.full(len(by), ",", object)
    if len(by):
        before[1:][sides[1:] != sides[:-1]] = "|"
        turned = np.flatnonzero(np.diff(numbers)) + 1
        before[turned] = ";"
        owner = stretch[by]
        before[np.flatnonzero(np.diff(owner, prepend=-1))] = ""
        parts = np.empty(2 * len(by), object)
        parts[::2], parts[1::2] = before, texts
        ends = 2 * np.searchsorted(owner, np.arange(count + 1))
        flat = parts.tolist()
        return ["".join(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return [""] * count


@lru_cache(1)  # a later query of the same worker takes the place of an earlier one
def _sides(vocabulary: bytes, model: pieces.Vocabulary) -> Sides:
    return Sides(vocabulary, model)


#: What ``aligned`` adds beside the key: links by their place in ``pairs``, which the last row of a chunk holds.
FOUND = (
    "n_a long, n_b long, n_groups long, n_links long, groups string, chunk long, links array<int>, "
    "pairs array<struct<a:int,b:int,times:long>>"
)


def chunk(sides: Sides, texts: list[str]) -> dict[str, pa.Array]:
    """The columns of some texts."""
    raw = [b" " + t.encode() if t else b"" for t in texts]
    begin = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    whole = b"".join(raw)
    data = np.frombuffer(whole, np.uint8)
    # both sides end a token at these places, whatever the texts are
    starts = np.intersect1d(subwords.stretches(data, begin), pieces.stretches(data, begin, sides.b.lines), True)
    offsets = pa.py_buffer(np.append(starts, begin[-1]).astype(np.int32))
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(whole)]).dictionary_encode()
    distinct = sides.numbers(found.dictionary.to_pylist())
    place = found.indices.to_numpy()
    bounds = np.searchsorted(starts, begin)
    # texts that a side spells otherwise have no tokens
    own = [np.diff(np.concatenate(([0], np.cumsum(part[distinct][place], dtype=np.int64)))[bounds]) for part in sides.sums]
    count = np.where(own[3] == np.diff(bounds), np.diff(bounds), 0)
    own = [np.where(count > 0, part, 0) for part in own]
    keep = np.arange(int(count.sum())) + np.repeat(bounds[:-1] - (np.cumsum(count) - count), count)
    place, ends = place[keep], np.concatenate(([0], np.cumsum(count)))
    groups = pa.array([sides.groups[i] for i in distinct.tolist()], pa.string()).take(pa.array(place))
    texts_ = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), groups), ";")
    links, to = subwords.gathered(sides.links, sides.n_links, distinct[place])
    to = np.concatenate(([0], to))[ends]
    codes, link, times = np.unique(links, return_inverse=True, return_counts=True)
    pairs = pa.StructArray.from_arrays(
        [pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(times)],
        ["a", "b", "times"],
    )
    last = pa.array([None] * (len(texts) - 1) + [0] + [len(pairs)], pa.int32())
    return {
        "n_a": pa.array(own[0]), "n_b": pa.array(own[1]), "n_groups": pa.array(own[2]),
        "n_links": pa.array(np.diff(to)), "groups": texts_,
        "links": pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(link.astype(np.int32))),
        "pairs": pa.ListArray.from_arrays(last, pairs),
    }


def aligned(
    docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str | None = None, model: str | None = None
) -> DataFrame:
    """One row per text: ``doc_id`` and the columns of ``FOUND``.

    A byte-level vocabulary (side a) encodes a blank and the text, a merge-type model (side b) the text, before which it
    puts the blank itself; strings of special tokens are plain text. ``groups`` reads ``a1,a2|b1;a3|b2,b3``. A text that is
    null or empty, or whose tokens' bytes on either side are not those of the blank and the text, has no tokens. Repeated
    rows are aligned each; other columns are left out.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((subwords.vocabulary_bytes(vocabulary), pieces.load(model)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(*shared.value)
        task = TaskContext.get().partitionId() << 32
        for number, (keys, texts) in enumerate(windows(batches, CHUNK_CHARS)):
            columns = {"doc_id": keys, "chunk": pa.array(np.full(len(texts), task + number)), **chunk(sides, texts)}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    schema = "doc_id long, " + FOUND
    names = [part.split()[0] for part in FOUND.split(", ")]
    names.insert(0, "doc_id")
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(rows, schema)


def counted(found: DataFrame) -> DataFrame:
    """What ``aligned`` found with the corpus's counts of linked ids: ``n_best``, the links whose count is the highest of
    their b id (ties included), and ``count_sum`` over the links. The other columns stay but ``chunk, links, pairs``."""
    found = materialize(found, "aligned")
    kept = [f for f in found.schema if f.name not in ("chunk", "links", "pairs")]
    pairs = found.filter("pairs IS NOT NULL").select(F.col("chunk").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    pairs = pairs.select("of", "place", "pair.*")
    totals = pairs.groupBy("a", "b").agg(F.sum("times").alias("total"))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))  # a row per id of side b, so of the model's size
    rated = totals.join(F.broadcast(highest), "b").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("best"))
    rated = pairs.join(rated, ["a", "b"]).select("of", "place", "total", "best")

    def summed(texts: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts["place"].to_numpy())
        links = texts["links"].combine_chunks()
        own = links.flatten().to_numpy()
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(links).to_numpy())))
        columns = [texts[f.name] for f in kept]
        for name in ("best", "total"):
            values = counts[name].to_numpy()[order].astype(np.int64)[own]
            columns.append(pa.array(np.diff(np.concatenate(([0], np.cumsum(values)))[ends])))
        return pa.table(columns, [f.name for f in kept] + ["n_best", "count_sum"])

    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    return found.drop("pairs").groupBy("chunk").cogroup(rated.groupBy("of")).applyInArrow(summed, schema)
