"""Encoding and decoding with a SentencePiece model whose pieces come from merges.

The encoding of every prefix of a text ends in one token only, so a table of these last tokens says all. It is filled
from left to right: an automaton names the pieces that end at a place, and the one whose pair with the last token of
what stands before it is compatible (the two texts together are merged into just these two) is the last token there.
The ids are read from the table backwards. Characters outside the vocabulary never merge; they are spelt in bytes and
the table begins anew after them.

No piece holds a blank after another character, so texts are cut before such blanks (and around lines, if the vocabulary
has no line end), and every distinct stretch is encoded once by a worker that remembers it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
REPLACEMENT = "�".encode()
NORMAL, BYTE, SILENT, UNKNOWN = range(4)
#: Marks in a table of last tokens: nothing found yet, and a place where a stretch begins.
NONE, START = -2, -1
#: Pairs of tokens whose test a worker remembers; beyond it, it starts again.
REMEMBERED_PAIRS = 400_000


@dataclass(frozen=True, eq=False)
class Vocabulary:
    """A model as tables of its pieces. ``whole`` marks pieces that the merges of their own characters give."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    whole: np.ndarray
    end: int
    unknown: str  # what the unknown token decodes to


def load(path: str | None = None) -> Vocabulary:
    """Read a model of merge type with byte fallback, a blank before every text and no other normalisation."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or subwords.vocabulary_path(MODEL))
    count = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(count)]
    scores = np.array([model.get_score(i) for i in range(count)])
    kinds = np.array(
        [BYTE if model.is_byte(i) else SILENT if model.is_control(i) else UNKNOWN if model.is_unknown(i) else NORMAL
         for i in range(count)], np.int8,
    )
    if count > 1 << 16:
        raise ValueError("models of at most 65,536 pieces")
    merges = {p: s for p, s, k in zip(pieces, scores.tolist(), kinds, strict=True) if k == NORMAL}
    whole = np.array([k == NORMAL and len(merged(p, merges)) == 1 for p, k in zip(pieces, kinds, strict=True)])
    return Vocabulary(pieces, scores, kinds, whole, model.eos_id(), model.decode([model.unk_id()]))


def merged(text: str, merges: dict[str, float]) -> list[str]:
    """A short text by the definition: the best pair is merged, the leftmost among equals, until none is left."""
    parts = list(text)
    while True:
        best, at = float("-inf"), -1
        for i in range(len(parts) - 1):
            score = merges.get(parts[i] + parts[i + 1], best)
            if score > best:
                best, at = score, i
        if at < 0:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


class PrefixTable:
    """Ids of stretches by the last tokens of their prefixes."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.pieces = vocabulary.pieces
        known = [i for i, k in enumerate(vocabulary.kinds) if k == NORMAL]
        self.merges = {self.pieces[i]: float(vocabulary.scores[i]) for i in known}
        self.size = [len(p) for p in self.pieces]
        self.characters = {self.pieces[i] for i in known if self.size[i] == 1}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(vocabulary.kinds) if k == BYTE}
        self.automaton = ahocorasick.Automaton()
        for i in known:
            if vocabulary.whole[i]:
                self.automaton.add_word(self.pieces[i], i)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the texts of two tokens, one after the other, are merged into these two."""
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        pair = [self.pieces[a], self.pieces[b]]
        found = self.pairs[a << 16 | b] = merged("".join(pair), self.merges) == pair
        return found

    def last_tokens(self, text: str) -> list[int]:
        """For every length of prefix its last token, or ``START`` after a character outside the vocabulary."""
        table = [START] + [NONE] * len(text)
        if not self.characters.issuperset(text):
            for i, c in enumerate(text, 1):
                if c not in self.characters:
                    table[i] = START
        size, known, test = self.size, self.pairs.get, self.compatible
        for place, token in self.automaton.iter(text):
            place += 1
            if table[place] == NONE:
                before = table[place - size[token]]
                if before >= 0:
                    fits = known(before << 16 | token)
                    if fits or fits is None and test(before, token):
                        table[place] = token
                elif before == START:
                    table[place] = token
        return table

    def spell(self, text: str) -> list[int]:
        """The ids of a text whose blanks are written as in the pieces."""
        table, place, ids = self.last_tokens(text), len(text), []
        while place:
            token = table[place]
            if token == START:
                place -= 1
                ids.extend(self.bytes[x] for x in reversed(text[place].encode()))
            elif token == NONE:
                raise ValueError(f"no token ends at {place} in {text[:80]!r}")
            else:
                ids.append(token)
                place -= self.size[token]
        return ids[::-1]


class PieceEncoder(subwords.Encoder):
    """Ids of whole texts, without an end; a text that is not empty gets a blank in front."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = PrefixTable(vocabulary)
        self.lines = "\n" not in self.table.characters
        self.forget()

    def raw(self, text: str) -> bytes:
        return b" " + text.encode() if text else b""

    def cuts(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return stretches(data, begin, self.lines)

    def spell(self, new: list[bytes]) -> list[list[int]]:
        return [self.table.spell(x.decode().replace(" ", BLANK)) for x in new]


def stretches(data: np.ndarray, begin: np.ndarray, lines: bool) -> np.ndarray:
    """Where the texts ``begin`` and where no token lies across: before a blank that follows another character (0x81
    may end a written blank), and around line ends if they are outside the vocabulary."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20) & (data[:-1] != 0x81)
    if lines:
        line = np.flatnonzero(data == 0x0A)
        cut[line] = cut[line + 1] = True
    cut[begin] = True
    return np.flatnonzero(cut[:-1])


class Decoder:
    """Texts of ids: control tokens are silent, and the blank in front of the text goes."""

    def __init__(self, vocabulary: Vocabulary):
        shown = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == SILENT else vocabulary.unknown.encode() if k == UNKNOWN
            else p.replace(BLANK, " ").encode() for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True)
        ]
        self.shown, self.kinds = shown, vocabulary.kinds
        self.flat, self.size = np.frombuffer(b"".join(shown), np.uint8), np.array([len(x) for x in shown], np.int64)
        self.blank = np.array([p.startswith(BLANK) for p in vocabulary.pieces]) & (vocabulary.kinds == NORMAL)

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> list[bytes]:
        """The texts whose ids lie one after the other and begin at ``begin`` (one more entry for the end)."""
        silent = np.append(self.kinds[ids] == SILENT, False)
        first = np.append(np.flatnonzero(~silent), len(ids))  # the first token of a text that shows
        first = first[np.searchsorted(first, begin[:-1])]
        blank = (first < begin[1:]) & np.append(self.blank[ids], False)[first]
        data, ends = subwords.gathered(self.flat, self.size, ids)
        ends = np.concatenate(([0], ends))
        data, bounds = data.tobytes(), ends[begin].tolist()
        found = [data[a + b : c] for a, b, c in zip(bounds, blank.tolist(), bounds[1:], strict=False)]
        for i, text in enumerate(found):
            try:
                text.decode()
            except UnicodeDecodeError:
                found[i] = self.repaired(ids[begin[i] : begin[i + 1]], blank[i])
        return found

    def repaired(self, ids: np.ndarray, blank: bool) -> bytes:
        """Bytes that make no character are replaced one by one; runs of byte tokens stand for themselves."""
        out, run = [], b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.kinds[i] == BYTE:
                run += self.shown[i]
                continue
            while run:
                try:
                    run.decode()
                    good = len(run)
                except UnicodeDecodeError as error:
                    good = error.start
                out.append(run[:good])
                if run := run[good:]:
                    out.append(REPLACEMENT)
                    run = run[1:]
            if i >= 0:
                out.append(self.shown[i])
        return b"".join(out)[int(blank) :]


@lru_cache(1)  # a later query of the same worker takes the place of an earlier one
def _encoder(vocabulary: Vocabulary) -> PieceEncoder:
    return PieceEncoder(vocabulary)


@lru_cache(1)
def _decoder(vocabulary: Vocabulary) -> Decoder:
    return Decoder(vocabulary)


def shared(context: SparkContext, path: str | None = None) -> Broadcast[Vocabulary]:
    """The model's tables for the workers; their size is the model's."""
    return context.broadcast(load(path))


def encode(
    docs: DataFrame, text: str = "text", out: str = "ids", end: bool = True, vocabulary: Broadcast[Vocabulary] | None = None
) -> DataFrame:
    """Add the column ``out array<int>``, the ids of each whole text, with the end id if asked for.

    A null text is empty, and an empty one has no ids but the end. All other columns and rows, repeated ones too, stay
    as they are; a column of the name ``out`` is replaced.
    """
    model = vocabulary or shared(docs.sparkSession.sparkContext)

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        ids, begin = _encoder(model.value).encode([t or "" for t in texts.to_pylist()])
        if end:
            ids, begin = np.insert(ids, begin[1:], model.value.end), begin + np.arange(len(begin))
        return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32)))

    return docs.withColumn(out, ids_of(F.col(text)))


def decode(
    encoded: DataFrame, ids: str = "ids", out: str = "decoded", vocabulary: Broadcast[Vocabulary] | None = None
) -> DataFrame:
    """Add the column ``out string``, the text of the ids. Null ids give null; ids outside the model are an error."""
    model = vocabulary or shared(encoded.sparkSession.sparkContext)

    @F.arrow_udf("string")
    def text_of(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = [0 if n is None else n for n in pc.list_value_length(lists).to_pylist()]
        begin = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        if len(flat) and not 0 <= flat.min() <= flat.max() < len(model.value.pieces):
            raise ValueError("ids outside the model")
        texts = [t.decode() for t in _decoder(model.value).decode(flat, begin)]
        return pa.array(texts, pa.string(), mask=np.asarray(lists.is_null()))

    return encoded.withColumn(out, text_of(F.col(ids)))
