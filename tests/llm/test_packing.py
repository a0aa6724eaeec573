"""Packing: an exact round trip, full sequences, and the encoder against the tokenizer itself."""

import zlib

import numpy as np
from sparkevents.llm import lm, packing, subwords
from tokenizers import Tokenizer

TEXTS = [
    "", "a", "two words", "  lead", "tail  ", "a  b\n\nc  d", "it's don't\n'll", "日本 語　テ", "x  y  z\u0085 q",
    "﻿ b", "l1\nl2\r\nl3\tl4", "\U0001d4b3 \U0001d4b4", "1 2\n3 #$ %", "éè ñ ß", "<|endoftext|> x", "\n", " ", "é e",
]


def plain(special_as_text=False):
    known = Tokenizer.from_file(subwords.vocabulary_path())
    if special_as_text:
        known.encode_special_tokens = True
    return lambda t: known.encode(t or "", add_special_tokens=False).ids


def test_encoder_gives_the_tokenizer_s_ids():
    encode, expected = subwords.encoder(subwords.vocabulary_bytes()).encode, plain(True)
    texts = TEXTS + [" ".join(TEXTS), "\n".join(TEXTS), "".join(TEXTS)]
    ids, begin = encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [expected(t) for t in texts]
    assert encode([])[0].size == 0 and encode([""])[1].tolist() == [0, 0]


def test_whole_texts_as_the_untouched_tokenizer():
    encode, expected = subwords.text_encoder(subwords.vocabulary_bytes()).encode, plain()
    texts = TEXTS + ["hello <|endoftext|> world", "a\n<|endoftext|>\n<|endoftext|>", "".join(TEXTS), " " * 500_000 + "x", "\n \t" * 9000]
    texts += ["z" * 40_000, "".join(chr(c) for c in range(32, 0x3000))]
    ids, begin = encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [expected(t) for t in texts]
    assert 50256 in expected(texts[len(TEXTS)]) and encode([])[0].size == 0


def test_encoder_after_words_with_repeats():
    encoder, expected = subwords.Encoder(subwords.vocabulary_bytes()), plain(True)
    for words in (["the", "cat", "the", "cat", "the"], ["a", "mat", "a"], ["the", "lastly", "mat"]):
        pieces, ends = lm.word_pieces(encoder, words, np.arange(len(words)))
        got = [pieces[a:b].tolist() for a, b in zip([0, *ends], ends)]
        assert got == [expected(" " + w) for w in words]
    ids, begin = encoder.encode(TEXTS)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [expected(t) for t in TEXTS]
    assert len(encoder.known) == len(encoder.size)


def test_every_document_comes_back(spark):
    long = " ".join(f"word{i % 977}" for i in range(9000))
    data = [(i, t, "x") for i, t in enumerate([*TEXTS, long, None, long, *(" ".join(TEXTS[:k]) for k in range(1, 18))])]
    data += [(5, TEXTS[5], "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, offset string").repartition(3)
    found = packing.pack(docs).toPandas()
    expected, texts = plain(), {}
    for i, t, _ in data:
        texts.setdefault(-1 if i is None else i, []).append([*expected(t), 2])
    found["doc_id"] = found["doc_id"].fillna(-1)
    for i, group in found.groupby("doc_id"):
        own = texts[i]
        assert len(group) == len(own) * -(-len(own[0]) // 1024)
        for r in group.itertuples():
            assert list(r.ids) == own[0][r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            assert r.piece == 0 or r.length == 1024
    assert set(found["doc_id"]) == set(texts)
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *group["length"].cumsum()[:-1]] and group["length"].sum() <= 1024
    assert packing.pack(docs.limit(0)).count() == 0
    assert "ids" not in packing.pack(docs, with_ids=False).columns


def test_bins():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # the fullest that fits
    assert bins.place(9) == (2, 0)
    assert bins.place(8) == (3, 0)  # the fullest of the two open ones (9 of 10) closes
    assert bins.place(4) == (0, 6) and bins.place(10) == (4, 0)
    assert bins.open <= 2


def test_few_sequences():
    draw = np.random.default_rng(1)
    sizes = np.sort(draw.integers(1, 1025, 5000))[::-1]
    bins = packing.OpenBins(1024, packing.OPEN_BINS)
    for s in sizes.tolist():
        bins.place(s)
    assert bins.made <= 1.02 * sizes.sum() / 1024 + 1
