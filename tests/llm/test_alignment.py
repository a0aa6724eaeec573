"""The alignment against both libraries and plain loops over whole texts."""

import hashlib
from collections import Counter

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from sparkevents.llm import alignment, pieces, queries, subwords

TEXTS = [
    "the quick brown fox", " lead", "a  b   c", "tail ", "line\nline\n\n  x\r\n\ty", "it's don't", "日本語 テ 한국어", "\U0001f600\U0001d4b3 x",
    "é è ﬁ", "<|endoftext|> <s> <0x0A>", "x▁y", "1234 567", "----====", "the the the", "\n", " ", "a", "\u0085 ﻿q　z",
]


def plain(texts):
    """Per text ``(n_a, n_b, groups, links)`` by the contract's words."""
    a, b = Tokenizer.from_file(subwords.vocabulary_path()), sentencepiece.SentencePieceProcessor(
        model_file=subwords.vocabulary_path(pieces.MODEL)
    )
    a.encode_special_tokens = True
    letters, found = subwords.byte_letters(), []
    names = {i: t for t, i in a.get_vocab().items()}

    def shown(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    for text in texts:
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        data = [bytes(letters[c] for c in names[i]) for i in ids[0]], [shown(i) for i in ids[1]]
        if not text or any(b"".join(x) != (" " + text).encode() for x in data):
            found.append((0, 0, "", []))
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in data]
        places = [{end: i + 1 for i, end in enumerate(side)} for side in ends]
        groups, links, at = [], [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [places[s][end] for s in (0, 1)]
            groups.append("|".join(",".join(map(str, ids[s][at[s] : to[s]])) for s in (0, 1)))
            links.append((ids[0][to[0] - 1], ids[1][to[1] - 1]))
            at = to
        found.append((len(ids[0]), len(ids[1]), ";".join(groups), links))
    return found


def expected(rows):
    found = plain([t for _, t in rows])
    counts = Counter(x for f in found for x in f[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, found):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_groups = groups.count(";") + 1 if groups else 0
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((i, n_a, n_b, n_groups, len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out, key=str)


def test_intervals():
    start, end = np.array([0, 4, 0, 2, 4, 5]), np.array([4, 6, 2, 4, 5, 6])
    side = np.array([0, 0, 1, 1, 1, 1])
    order, group = alignment.coalesced(start, end)
    assert [(int(start[i]), int(g)) for i, g in zip(order, group)] == [(0, 0), (0, 0), (2, 0), (4, 1), (4, 1), (5, 1)]
    left, right = alignment.overlaps(order, group, side, start, end)
    assert sorted(zip(left.tolist(), right.tolist())) == [(0, 2), (0, 3), (1, 4), (1, 5)]


def test_groups_and_counts(spark, monkeypatch):
    long = " ".join(f"word{i % 5000} and" for i in range(20_000)) + "z" * 3000
    rows = [*enumerate([*TEXTS, None, "", long, "".join(TEXTS[:10])]), (0, TEXTS[0]), (None, "no id")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, chunk int").repartition(3)
    found = alignment.aligned(docs)
    texts = {(r["doc_id"], r["n_a"]): r["groups"] for r in found.collect()}
    for (i, _), (n_a, _, groups, _) in zip(rows, plain([t for _, t in rows])):
        assert texts[i, n_a] == groups
    wanted = [r[:7] for r in expected(rows)]
    got = alignment.counted(found.drop("groups"))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=str) == sorted(wanted, key=str)
    assert alignment.counted(alignment.aligned(docs.limit(0))).count() == 0
    assert alignment.counted(alignment.aligned(docs.filter("text is null"))).select(columns[1:]).collect() == [(0,) * 6]


def test_a_worker_that_forgets(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 4)
    sides = alignment.Sides(subwords.vocabulary_bytes(), pieces.load())
    for text, (n_a, n_b, groups, links) in zip(TEXTS, plain(TEXTS)):
        found = alignment.chunk(sides, [text, "", text])
        assert found["n_a"].to_pylist() == [n_a, 0, n_a] and found["n_b"].to_pylist() == [n_b, 0, n_b]
        assert found["groups"].to_pylist() == [groups, "", groups]
        pairs = found["pairs"].to_pylist()
        assert pairs[:2] == [None, None]
        assert [(pairs[2][i]["a"], pairs[2][i]["b"]) for i in found["links"].to_pylist()[2]] == links


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op12_token_alignment(spark, folder).collect()]
    assert sorted(got, key=str) == expected(rows)
