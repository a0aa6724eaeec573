"""Language, quality and toxicity: held-out accuracy on invented texts, and edge cases."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from sparkevents.llm import langid, quality, toxicity
from sparkevents.llm.common import held_out, learnable

SYLLABLES = {"xx": "ba ko ri tu ma le".split(), "yy": "sch ung ein ber ich zu".split(), "zz": "ção ñor ué lla oix qui".split()}
ODD = [(9001, None), (9002, ""), (9003, " \n"), (9004, "12 34 !?"), (None, "ba ko ri"), (9005, "日本語テキスト"), (9006, "a"), (9007, "ba " * 60_000)]


def prose(draw, lang, n=60):
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(n))


def test_languages(spark):
    draw = random.Random(1)
    data = [(i, prose(draw, lang), lang, "s") for i in range(300) for lang in [draw.choice(["xx", "xx", "yy", "zz"])]]
    data += [(i, t, None, "s") for i, t in ODD]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, language string")
    model = langid.train(docs, learnable(3, 1), rows=60)
    found = langid.predict(docs.select("doc_id", "text"), model).withColumn("held", held_out(3, 1)).collect()
    true = {i: lang for i, _, lang, _ in data if lang}
    held = [r for r in found if r["held"] and r["doc_id"] in true]
    assert len(held) > 60 and all(r["language"]["lang_pred"] == true[r["doc_id"]] for r in held)
    odd = {r["doc_id"]: r["language"] for r in found if r["doc_id"] not in true}
    assert all(tuple(odd[i]) == ("und", 0.0) for i in (9001, 9002, 9003, 9004))
    assert odd[None]["lang_pred"] == odd[9007]["lang_pred"] == "xx" and odd[9005]["lang_pred"] in model.languages
    assert all(0 <= r["language"]["score"] <= 1 for r in found) and len(found) == len(data)


def test_no_language_learned(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "xx")], "doc_id long, text string, lang string")
    model = langid.train(docs, learnable(3, 1))
    assert rows(langid.predict(docs, model).select("language.lang_pred")) == [("und",), ("und",)]
    assert langid.predict(docs.limit(0), model).count() == 0


def test_bundle_is_the_sum_of_bound_letters():
    letters = langid.Letters(64, 3)
    v = {c: letters.vector(ord(c)).astype(int) for c in " abc"}
    gram = lambda a, b, c: np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    expected = gram(" ", "a", "b") + gram("a", "b", " ") + gram("b", " ", "c") + gram(" ", "c", " ")
    texts = ["ab--9 C", "", "ab c", "7"]
    got = langid.bundles(texts, letters)
    assert (got[0] == expected).all() and (got[2] == expected).all() and not got[1].any() and not got[3].any()


def junk(draw, kind, text):
    words = text.split()
    if kind == 0:
        return " ".join(w + draw.choice(["%%%", "###", "&&&"]) for w in words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join(w for w in words[:8] for _ in range(9))


def labelled(spark, data, label):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in data], "doc_id long, text string, score double")
    return docs, spark.createDataFrame([(i, y) for i, _, y in data], f"doc_id long, {label} int")


def test_quality(spark):
    draw = random.Random(2)
    data = []
    for i in range(500):
        text, good = prose(draw, draw.choice(list(SYLLABLES)), draw.randint(20, 200)), draw.random() < 0.7
        data.append((i, text if good else junk(draw, draw.randrange(3), text), int(good)))
    data += [(i, t, y) for (i, t), y in zip(ODD, [0, 1, None, 7, 1, 1, 1, 0])]
    docs, labels = labelled(spark, data, "quality")
    found = quality.scored(docs, labels.unionByName(labels.filter("doc_id < 20")), learnable(5, 0), held_out(5, 1))
    got = {r["doc_id"]: r["score"] for r in found.collect()}
    assert len(got) == len(data) and all(0 <= s <= 1 for s in got.values())
    held = {r["doc_id"] for r in docs.filter(held_out(5, 0)).collect()}
    right = [(got[i] >= quality.THRESHOLD) == bool(y) for i, _, y in data if i in held and i is not None and i < 9000]
    assert len(right) > 60 and np.mean(right) >= 0.97
    none = quality.scored(docs, labels.limit(0), learnable(5, 0), held_out(5, 1))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert quality.scored(docs.limit(0), labels, learnable(5, 0), held_out(5, 1)).count() == 0


def test_isotonic_fit_rises():
    draw = np.random.default_rng(1)
    n = draw.integers(1, 20, 60).astype(float)
    good = np.minimum(n, np.rint(n * np.clip(np.linspace(0, 1, 60) + draw.normal(size=60) * 0.3, 0, 1)))
    levels = quality.isotonic(good, n)
    assert (np.diff(levels) >= 0).all() and len(levels) == 60 and 0 < levels.min() and levels.max() < 1


def test_toxicity(spark):
    draw = random.Random(3)
    data = []
    for i in range(600):
        words, bad = prose(draw, draw.choice(list(SYLLABLES)), 80).split(), draw.random() < 0.3
        for _ in range(3 * bad):
            words[draw.randrange(80)] = draw.choice(["Vragnok", "smelth", "puxdorf"])
        data.append((i, " ".join(words), int(bad)))
    data += [(i, t, y) for (i, t), y in zip(ODD, [0, 1, None, 7, 1, 0, 0, 0])]
    docs, labels = labelled(spark, data, "toxic")
    model = toxicity.train(docs, labels, learnable(3, 1))
    scored = toxicity.score(docs, model).select("doc_id", "score").collect()
    got = {r["doc_id"]: r["score"] for r in scored}
    assert len(scored) == len(data) and all(0 <= s <= 1 for s in got.values())
    held = {r["doc_id"] for r in docs.filter(held_out(3, 1)).collect()}
    right = [(got[i] >= toxicity.THRESHOLD) == bool(y) for i, _, y in data if i in held and i is not None and i < 9000]
    assert len(right) > 150 and np.mean(right) >= 0.98
    assert got[9001] == got[9002] < 0.7 and got[9007] < 0.7


def test_toxicity_without_both_classes(spark):
    docs, labels = labelled(spark, [(1, "a b", 0), (2, "c", 0), (4, None, 0), (5, "x", None)], "toxic")
    model = toxicity.train(docs, labels, F.lit(True))
    assert all(r["score"] < 0.01 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("chars", [1 << 20, 50])
def test_n_grams_of_a_batch_and_of_one_text(monkeypatch, chars):
    monkeypatch.setattr(toxicity, "CHARS", chars)
    draw = random.Random(4)
    texts = [prose(draw, "xx", 30), "", "a", "ab", prose(draw, "zz", 300)]
    place = np.arange(1 << toxicity.BITS, dtype=np.int32)
    place[::2] = -1
    for i, own in toxicity.hits(texts, place):
        codes = np.frombuffer(f" {texts[i]} ".encode("utf-32-le"), np.uint32)
        grams = np.unique(np.concatenate(toxicity.buckets(codes)))
        assert own.tolist() == grams[grams % 2 == 1].tolist()
