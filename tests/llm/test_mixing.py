"""Source mixing against a plain calculation of targets, and its limits."""

import re

import pytest
from pyspark.sql import functions as F
from sparkevents.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix int, size string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows], SCHEMA)


def plain_targets(sizes):
    """Targets by sharing the excess of capped sources again and again."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not over:
            target.update({s: share * weight[s] for s in open_})
            break
        target.update({s: 3.0 * sizes[s] for s in over})
        left -= sum(3.0 * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("counts", [{"a": 30, "b": 30, "c": 30, None: 5}, {"z": 1, "b": 400, "é": 3, "Z": 7}, {"only": 9}])
def test_targets_and_taken_words(spark, counts):
    rows, i = [], 0
    for s, n in counts.items():
        for k in range(n):
            rows.append((i, "w " * (1 + (k * 7) % 13), s))
            i += 1
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    found = mixing.mix(docs(spark, rows)).select("doc_id", "source", "mix.*").collect()
    assert len(found) == len(rows)
    expected = plain_targets(sizes)
    taken = {}
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 2 * 13
    again = mixing.mix(docs(spark, rows[::-1]).repartition(3)).select("doc_id", "mix.copies").collect()
    assert {r["doc_id"]: r["copies"] for r in found} == {r["doc_id"]: r["copies"] for r in again}


def test_words_are_split_at_ascii_white_space(spark):
    texts = ["", " ", "a", " a\tb\x0b\x0c\r\nc ", "a b   c", None, "\n\n", "x " * 5000]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in found] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_edges(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    found = mixing.mix(docs(spark, [(None, None, None), (None, None, None), (1, "", "a"), (2, None, "a")])).collect()
    assert len(found) == 4 and all(r["mix"]["taken"] == 0 and r["mix"]["target"] == 0.0 for r in found)
    # repeated rows count each; columns of the same names as the operator's own stay what they were
    same = mixing.mix(docs(spark, [(7, "a b", "s")] * 6)).collect()
    assert [r["mix"]["target"] for r in same] == [12.0] * 6 and sum(r["mix"]["taken"] for r in same) == 12
    assert {r["size"] for r in same} == {"x"}


def test_a_large_group_of_equal_sizes_is_cut(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 10)
    rows = [(i, "a b c", "hot") for i in range(500)] + [(1000 + i, "a", "cold") for i in range(50)]
    found = mixing.mix(docs(spark, rows)).select("source", "mix.*").collect()
    expected = plain_targets({"hot": 1500, "cold": 50})
    for s in ("hot", "cold"):
        assert abs(sum(r["taken"] for r in found if r["source"] == s) - expected[s]) <= 3


def test_emitted_rows(spark):
    rows = [(i, "a b", "s" if i % 2 else "t") for i in range(40)]
    counts = {r["doc_id"]: r["mix"]["copies"] for r in mixing.mix(docs(spark, rows)).collect()}
    emitted = mixing.emit(docs(spark, rows).drop("mix"))
    assert emitted.columns == ["doc_id", "text", "source", "size"]
    got = {r["doc_id"]: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in counts.items() if v}
