"""Subword ids of many texts at once: every distinct stretch between blanks is encoded once."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import json
import os
import re
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa

VOCABULARY = "byte_bpe_50k.json"
#: Distinct stretches that a Python worker remembers; beyond it, it starts again.
REMEMBERED = 500_000
#: Characters of white space in a row that the faster library takes (it was seen to take 300,000).
BLANKS = 10_000
_BLANKS = re.compile(rf"\s{{{BLANKS}}}")

# Classes of bytes. A blank between two characters that are surely not white space begins a new token of the
# byte-level pattern whatever stands around it, so texts may be cut there. Two-byte characters from C3 on are no blanks.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_bytes(path: str | None = None) -> bytes:
    """The vocabulary file, to be sent to the workers (its size is fixed)."""
    with open(path or vocabulary_path(), "rb") as f:
        return f.read()


class Encoder:
    """Ids of whole texts; strings of special tokens in a text are ordinary text."""

    def __init__(self, vocabulary: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        """Known stretches by number; their ids lie one after the other in ``flat``."""
        self.known: dict[bytes, int] = {}
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def raw(self, text: str) -> bytes:
        return text.encode()

    def cuts(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return stretches(data, begin)

    def spell(self, new: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([x.decode() for x in new], add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids begin (one more entry for the end)."""
        raw = [self.raw(t) for t in texts]
        begin = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(x) for x in raw], out=begin[1:])
        whole = b"".join(raw)
        starts = self.cuts(np.frombuffer(whole, np.uint8), begin)
        data = pa.py_buffer(whole)
        offsets = np.append(starts, begin[-1]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), data]).dictionary_encode()
        numbers = self.numbers(found.dictionary.to_pylist())
        ids, ends = gathered(self.flat, self.size, numbers[found.indices.to_numpy()])
        ends = np.concatenate(([0], ends))
        return ids, ends[np.searchsorted(starts, begin)]

    def numbers(self, stretches: list[bytes]) -> np.ndarray:
        """The stretches' numbers; new ones are encoded first. Stretches may be repeated."""
        if len(self.known) > REMEMBERED:
            self.forget()
        numbers = list(map(self.known.get, stretches))
        # a number is a place in ``size``
        new = list(dict.fromkeys(x for x, n in zip(stretches, numbers, strict=True) if n is None))
        lists = self.spell(new)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(size.sum()))
        self.flat, self.size = np.append(self.flat, flat), np.append(self.size, size)
        return np.array([self.known[x] if n is None else n for x, n in zip(stretches, numbers, strict=True)], np.int64)


class TextEncoder:
    """Ids of whole texts as the tokenizer gives them; strings of added tokens in a text are these tokens.

    The same merges run in a library for ranks, which is several times faster on whole texts. It can't take very long
    runs of white space; texts that hold one go to the tokenizer.
    """

    def __init__(self, vocabulary: bytes):
        import tiktoken
        from public_tokenizers import PATTERN

        letters, file = byte_letters(), json.loads(vocabulary)
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in file["model"]["vocab"].items() if t not in added}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.shown = {i: t for t, i in ranks.items()}
        self.vocabulary = vocabulary

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids begin (one more entry for the end)."""
        fast = self.fast.encode
        lists = [slow(self.vocabulary, t) if blank(t) else fast(t, allowed_special="all") for t in texts]
        begin = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=begin[1:])
        return np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(begin[-1])), begin

    def plain(self, texts: list[bytes]) -> list[list[int]]:
        """The ids of each text; strings of added tokens are ordinary text."""
        fast, found = self.fast.encode_ordinary, [x.decode() for x in texts]
        return [slow(self.vocabulary, t, True) if blank(t) else fast(t) for t in found]

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id; an added token has none."""
        return [self.shown.get(i, b"") for i in range(self.fast.max_token_value + 1)]


def blank(text: str) -> bool:
    """Whether a text holds a very long run of white space."""
    return len(text) >= BLANKS and _BLANKS.search(text) is not None


def slow(vocabulary: bytes, text: str, plain: bool = False) -> list[int]:
    """The ids from the tokenizer itself."""
    return _tokenizer(vocabulary, plain).encode(text, add_special_tokens=False).ids


@cache
def _tokenizer(vocabulary: bytes, plain: bool):
    from tokenizers import Tokenizer

    found = Tokenizer.from_buffer(vocabulary)
    if plain:
        found.encode_special_tokens = True
    return found


def stretches(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where the texts ``begin`` and where they may be cut without changing a token."""
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    if len(data) > 2:
        before[1:] = _PLAIN[data[:-1]]
        before[2:] |= _LEAD[data[:-2]] & (data[1:-1] >= 0x80)
        after[:-1] = (_PLAIN | _LEAD)[data[1:]]
    alone = before & after
    line = np.flatnonzero((data == 0x0A) & alone)
    cut = (data == 0x20) & alone
    cut[line] = True
    cut[line[line + 1 < len(data)] + 1] = True
    cut[begin[:-1][begin[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def gathered(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists number ``index`` of a flat store of lists of ``size``, one after the other, and where each ends."""
    start = np.cumsum(size) - size
    count = size[index]
    ends = np.cumsum(count)
    place = np.arange(int(count.sum())) + np.repeat(start[index] - (ends - count), count)
    return flat[place], ends


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in shown]
    return {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}


@lru_cache(1)
def text_encoder(vocabulary: bytes) -> TextEncoder:
    """One encoder of whole texts for each worker process."""
    return TextEncoder(vocabulary)


@cache
def encoder(vocabulary: bytes) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(vocabulary)


def release() -> None:
    """Give up the worker's encoder and hand back the memory that the libraries keep beside what comes after it."""
    encoder.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries hand it back by themselves
        ctypes.CDLL(None).malloc_trim(0)
