"""The prefix table and the decoder against the library that owns the model."""

import hashlib
import random

import numpy as np
import sentencepiece

from sparkevents.llm import pieces, queries, subwords

TEXTS = [
    "", " ", "a", "   lead", "tail  ", "x▁y ▁ z", "<0x0A> <s> </s>", "line\nline\r\n\n", "\0 nul", "日本語　テ 한국어", "\U0001f600 \U0001d4b3",
    " " * 15 + "x", "x" + " " * 47 + "日", "=" * 33 + "----/**/", "a" * 70, "007 3.14", "ﬁ ß é é", "﻿b", "\u0085 q",
]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=subwords.vocabulary_path(pieces.MODEL))


def test_ids_and_texts_equal_the_library_s():
    plain, model = library(), pieces.load()
    encoder, decoder = pieces.PieceEncoder(model), pieces.Decoder(model)
    draw = random.Random(3)
    alphabet = [p.replace("▁", " ") for p in draw.sample(model.pieces[259:], 2000)] + TEXTS
    texts = TEXTS + ["".join(draw.choices(alphabet, k=draw.randrange(30))) for _ in range(3000)]
    texts += ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(160, 0x3100)])) for _ in range(40)) for _ in range(500)]
    ids, begin = encoder.encode(texts)
    expected = plain.encode(texts, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == expected
    assert [t.decode() for t in decoder.decode(ids.astype(np.int64), begin)] == plain.decode(expected)


def test_any_ids_decode_as_in_the_library():
    plain, decoder = library(), pieces.Decoder(pieces.load())
    byte = [plain.piece_to_id(f"<0x{x:02X}>") for x in range(256)]
    lists = [
        [], [2], [1, 261, 2], [0, 261], [261, 0], [byte[255], 2], [byte[0xE2], byte[0x82], 261], [byte[0xE2], 0, byte[0x82]],
        [28705, byte[255], 300], [byte[0xF0], byte[0x9F], byte[0x98], byte[0xE2], byte[0x82], byte[0xAC]], [1, 2, 2], [259, 261],
    ]
    begin = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    flat = np.array([i for x in lists for i in x], np.int64)
    assert [t.decode() for t in decoder.decode(flat, begin)] == [plain.decode(x) for x in lists]


def test_every_prefix_ends_in_its_last_token():
    plain, table = library(), pieces.PrefixTable(pieces.load())
    text = "▁the▁▁▁quickest---brown\nfoxes▁1234"
    last = table.last_tokens(text)
    assert last[text.index("\n") + 1] == pieces.START
    for end in range(1, text.index("\n")):
        assert last[end] == plain.encode(text[1:end].replace("▁", " "))[-1] if end > 1 else last[end] == plain.piece_to_id("▁")


def test_a_worker_that_forgets(monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "REMEMBERED_PAIRS", 2)
    plain, encoder = library(), pieces.PieceEncoder(pieces.load())
    for text in TEXTS:
        ids, begin = encoder.encode([text, text, ""])
        assert ids.tolist() == plain.encode(text) * 2 and begin[-1] == begin[-2]


def test_columns(spark):
    long = " ".join(f"word{i}" for i in range(60_000)) + " " * 5000 + "z" * 50_000
    rows = [(i, t, "kept") for i, t in enumerate([*TEXTS, None, long])] + [(0, TEXTS[3], "kept"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string").repartition(3)
    model = pieces.shared(spark.sparkContext)
    found = pieces.decode(pieces.encode(docs, vocabulary=model), out="back", vocabulary=model)
    assert found.columns == ["doc_id", "text", "decoded", "ids", "back"]
    plain = library()
    got = sorted((tuple(r) for r in found.collect()), key=str)
    expected = [(*r, plain.encode(r[1] or "", add_eos=True), plain.decode(plain.encode(r[1] or ""))) for r in rows]
    assert got == sorted(expected, key=str)
    assert pieces.decode(pieces.encode(docs.limit(0))).count() == 0
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in pieces.decode(nothing, vocabulary=model).collect()] == [None, ""]


def test_query(spark):
    plain = library()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op13_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(plain.decode(ids).encode()).hexdigest()
