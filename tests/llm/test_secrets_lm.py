"""Secret spans against plain patterns; language-model scores against a plain word model and as a probability."""

import hashlib
import math
import os
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from sparkevents.llm import lm, secrets, subwords
from sparkevents.llm.common import held_out, learnable

HEX = "0123456789abcdef" * 2
TEXTS = [
    "password=abcdef1 x", "PassWD: 'short", "secret=token=abcdefg", "secret=token: abcdefgh", "api_key = \"K9/x+y_z.=-\" ApIkey:123456",
    "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, "xAKIAAKIA" + "Z" * 16, HEX, "z" + HEX[:23], "é" + HEX[:24] + "g", "token = \"" + HEX + "\"",
    "tokenpassword:  \"\"abcdef", "", None, "\U0001d4b3 password=" + "a" * 50_000, "ſecret=abcdefgh ToKen=abcdefgh",
]
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(spans)]


@pytest.fixture(scope="module")
def model(spark):
    parts = "read write table column index value count some function name identifier under score abstract factory used by in".split()
    words = [f"{a}_{b}{i % 30}" if i % 2 else f"{a}{b.title()}{i % 7}" for i, a in enumerate(parts * 9) for b in parts]
    return secrets.train(spark.createDataFrame([(w, False) for w in words], "token string, is_random boolean"))


def test_base_spans(spark, model):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_hex int")
    found = secrets.digests(secrets.scan(docs, model)).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        spans = plain(TEXTS[r["doc_id"]])
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, *_ in spans) for x in ("assign", "access", "hex")]
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("random")) == shown
    assert secrets.digests(secrets.scan(docs.limit(0), model)).count() == 0


def test_random_strings_and_identifiers(model):
    text = "key q7Zt0XbR9LmW2vKd8YpS used by some_function_name_2 in readTableIdentifier22 and 4242424242424242"
    assert [text[s:e] for s, _, e in secrets.random_spans(text, [], model)] == ["q7Zt0XbR9LmW2vKd8YpS"]


def test_keys_of_one_kind_of_character_and_beside_fixed_patterns(model):
    letters, mixed = "qXzVbTjWkRpGvMxLwHcF", "q7Zt0XbR9LmW2vKd8YpS"
    text = f"id {letters} but somefunctionidentifier 20240131123456789012 /usr/share/common/files/ {mixed}/AKIA{'Q7' * 8}/{mixed} {mixed}-{HEX}"
    found = secrets.random_spans(text, secrets.base_spans(text), model)
    assert [text[s:e] for s, _, e in found] == [letters, f"{mixed}/", f"/{mixed}", f"{mixed}-"], [text[s:e] for s, _, e in found]
    assert secrets.random_spans("zq" + HEX + "x9", secrets.base_spans("zq" + HEX + "x9"), model) == []


def plain_random(text, model):
    """What is left of each token, character by character."""
    covered = {i for s, _, e in secrets.base_spans(text) for i in range(s, e)}
    found = []
    for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text):
        free = "".join("." if i in covered else text[i] for i in range(*m.span()))
        found += [(m.start() + x.start(), 3, m.start() + x.end()) for x in re.finditer("[^.]{16,}", free) if model.is_random(x.group())]
    return found


def test_random_spans_against_plain_ones(model):
    draw = np.random.default_rng(3)
    parts = ["token=", "q7Zt0XbR9LmW2vKd8YpS", HEX, "AKIA" + "Z9" * 9, " ", "/", "secret: ", "word_of_text_here", "qXzVbTjWkRpGvMxL", "password=\"", '"']
    hits = 0
    for _ in range(400):
        text = "".join(draw.choice(parts, draw.integers(1, 12)))
        found = secrets.random_spans(text, secrets.base_spans(text), model)
        assert found == plain_random(text, model), text
        hits += len(found)
    assert hits > 100


def test_words_of_the_corpus_are_no_secrets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    assert found.selectExpr("explode(spans) AS s").filter("s.kind = 'random'").count() == 0


def test_redaction(spark, model):
    data = [(i, t, len(t) if t is not None else None) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_chars int")
    for r in secrets.redacted(docs, model).collect():
        before = TEXTS[r["doc_id"]]
        assert not plain(r["text"]) and r["n_chars"] == (None if before is None else len(r["text"]))
        assert plain(before) or secrets.random_spans(before or "", [], model) or r["text"] == before
    assert secrets.redacted(docs, model).columns == docs.columns


def test_samples(spark):
    docs = spark.createDataFrame([(1, "password=abcdefgh1 plain_word other")], "doc_id long, text string")
    got = {(r["token"], r["is_random"]) for r in secrets.labelled_samples(docs).collect()}
    assert got == {("abcdefgh1", True), ("plain_word", False), ("other", False)}


def words(text):
    return (text or "").encode().lower().split()


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "ROUNDS", 2)
    monkeypatch.setattr(lm, "BUCKET_WORDS", 20)
    data = [(i, f"The Cat {i % 7} sat on the MAT_{i % 5}\tand\x0bslept éÉ") for i in range(80)]
    data += [(900, None), (901, ""), (902, " \n "), (903, "unseenword " * 3000), (None, "the cat"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in data], "doc_id long, text string, score double").repartition(3)
    found = lm.score(docs, learnable(7, 2), held_out(7, 2)).collect()
    assert len(found) == len(data)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter()
    for i, t in data:
        if i is not None and not held(i):
            counts.update([*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in data:
        own = [counts[w] for w in [*words(t), None]]
        base = sum(math.log10((c + 1) / (total + kinds + 1)) for c in own)
        expected[i, held(i), len(own), sum(c > 0 for c in own), total, round(base, 6)] += 1
    got = Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found
    )
    assert got == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert lm.score(docs.limit(0), learnable(7, 2), held_out(7, 2)).count() == 0


def test_training_sums_every_target_of_every_learned_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "improve", lambda model, sums, *_: seen.append(sums))
    monkeypatch.setattr(lm, "ROUNDS", 1)
    data = [(i, f"word{i % 50} common text number{i}") for i in range(900)] + [(10_001, "cat mat " * 9_000), (None, "x y")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    lm.score(docs, learnable(7, 2), held_out(7, 2))
    learned = [words(t) for i, t in data if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learned for w in t)
    encoder = subwords.Encoder(subwords.vocabulary_bytes())
    expected = np.zeros(lm.VOCABULARY)
    expected[lm.END] = lm.OFTEN * len(learned)
    for w, n in counts.items():
        ids, _ = lm.word_pieces(encoder, [w.decode()], np.arange(1))
        np.add.at(expected, ids, n * (1.0 if n <= lm.RARE else lm.OFTEN))
    assert len(learned) > 700 and b"cat" in counts
    assert seen[0][:-1, lm.EMITS].sum(1) == pytest.approx(expected, rel=1e-3, abs=1e-6)
    assert seen[0][:-1, lm.VOTES].sum() == pytest.approx(expected.sum(), rel=1e-3)


def test_sums_by_token_are_those_of_reduceat_without_a_copy_of_all_rows():
    draw = np.random.default_rng(4)
    count = [*range(1, 150), 300, 1000, 1, 1, 2, 2]
    tokens = draw.permutation(np.repeat(np.arange(len(count)) * 3, count))
    values = draw.normal(size=(len(tokens), 48)).astype(np.float32)
    for n in (len(tokens), 40, 1, 0):
        found, expected = np.ones((500, 48)), np.ones((500, 48))
        order = np.argsort(tokens[:n], kind="stable")
        kinds, at = np.unique(tokens[:n][order], return_index=True)
        expected[kinds] += np.add.reduceat(values[:n][order], at, axis=0)
        lm.summed(values[:n], tokens[:n], found)
        assert np.array_equal(found, expected)
    out = np.zeros((2_000, 48))
    tracemalloc.start()
    lm.summed(values[:8_000], np.arange(8_000) % 1_000, out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.8 * values[:8_000].nbytes


def small_model():
    draw = np.random.default_rng(0)
    emits = draw.dirichlet(np.ones(lm.VOCABULARY) * 0.1 + 0.05, 4).T
    votes = draw.dirichlet(np.ones(4), lm.VOCABULARY)
    begins = lm.word_begins(subwords.vocabulary_bytes())
    key = lambda: draw.normal(size=(lm.VOCABULARY, 8)).astype(np.float32)
    place = (-0.3 * np.arange(lm.WINDOW)).astype(np.float32)
    return lm.LanguageModel(key(), key(), votes.astype(np.float32), emits.astype(np.float32), place, begins)


def test_attention_scores_each_token_once_from_the_past_only():
    model = small_model()
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 50_000, n) for n in (1, 7, 8, 9, 40, 100)]
    ids, begin = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    own, border = lm.log_chances(model, ids, begin)
    reach = lm.WINDOW
    for t, at in zip(texts, begin):
        inputs = [lm.END, *t[:-1].tolist()]
        for i in range(len(t)):
            first = max(0, i // lm.STRIDE * lm.STRIDE + lm.STRIDE - reach)
            past = inputs[first : i + 1]
            score = np.array([model.query[inputs[i]] @ model.key[x] + model.place[i - first - j] for j, x in enumerate(past)])
            weight = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
            chances = (weight @ model.votes[past]) @ model.emits.T
            assert chances.sum() == pytest.approx(1, abs=1e-4)
            assert own[at + i] == pytest.approx(math.log10(chances[t[i]]), abs=1e-3)
            assert border[at + i] == pytest.approx(math.log10(chances[model.begins].sum()), abs=1e-3)


def test_statistics_of_a_round_against_plain_sums_of_every_pair(monkeypatch):
    monkeypatch.setattr(lm, "BLOCKS", 2)
    monkeypatch.setattr(lm, "MET", 4)
    monkeypatch.setattr(lm, "PRODUCT_ROWS", 6)
    monkeypatch.setattr(lm, "LAID_OUT", 150)
    draw = np.random.default_rng(2)
    model = lm.begun(np.full(lm.VOCABULARY, 1 / lm.VOCABULARY), np.zeros(lm.VOCABULARY, bool))
    sizes = np.array([1, 40, 0, 31, 32, 70, 100, 33])
    lengths = draw.integers(1, 3, 50)
    pieces, counts = draw.integers(0, 60, lengths.sum()) * 800, draw.integers(1, 6, 50)
    numbers, learned = draw.integers(0, 50, sizes.sum()), np.arange(8) != 3
    found, parts = np.zeros(lm.SUMS), 0
    for part in lm.windows(learned, sizes, numbers, counts, pieces, lengths):
        lm.add_statistics(found, model, *part)
        parts += 1
    assert parts > 2
    expected = np.zeros(lm.SUMS)
    begin, ends = np.cumsum(sizes) - sizes, np.cumsum(lengths)
    for text in np.flatnonzero(learned):
        own = numbers[begin[text] : begin[text] + sizes[text]]
        ids = [int(x) for w in own for x in pieces[ends[w] - lengths[w] : ends[w]]] + [lm.END]
        weight = [1.0 if counts[w] <= lm.RARE else lm.OFTEN for w in own for _ in range(lengths[w])] + [lm.OFTEN]
        inputs = [lm.END, *ids[:-1]]
        for i, (t, n) in enumerate(zip(ids, weight, strict=True)):
            first = max(0, i // lm.STRIDE * lm.STRIDE + lm.STRIDE - lm.WINDOW)
            past, away = np.array(inputs[first : i + 1]), i - np.arange(first, i + 1)
            a = np.exp(model.key[past].astype(float) @ model.query[inputs[i]] + model.place[away])
            a /= a.sum()
            joint = a[:, None] * model.votes[past] * model.emits[t]
            joint *= n / joint.sum()
            push = joint.sum(1) - n * a
            np.add.at(expected[:, lm.VOTES], past, joint)
            expected[t, lm.EMITS] += joint.sum(0)
            expected[inputs[i], lm.QUERY] += push @ model.key[past]
            np.add.at(expected[:, lm.KEY], past, push[:, None] * model.query[inputs[i]])
            np.add.at(expected[lm.VOCABULARY], away, push)
    assert lm.with_factors(found, model) == pytest.approx(expected, rel=1e-3, abs=1e-4)


def test_windows_of_a_large_batch_are_laid_out_some_texts_at_a_time():
    def peak(texts):
        sizes, numbers = np.full(texts, 1_000), np.arange(texts * 1_000) % 50
        tracemalloc.start()
        for part in lm.windows(np.ones(texts, bool), sizes, numbers, np.ones(50, int), np.arange(50), np.ones(50, int)):
            assert len(part[0]) <= lm.LAID_OUT // lm.STRIDE + len(sizes)
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found / texts

    assert peak(2_000) < 0.6 * peak(200)


def test_scoring_of_a_large_batch_lays_out_some_texts_at_a_time(monkeypatch):
    model = small_model()
    draw = np.random.default_rng(5)
    sizes = draw.integers(0, 300, 800)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    ids = draw.integers(0, 50_000, begin[-1])

    def peak(texts):
        tracemalloc.start()
        found = lm.log_chances(model, ids[: begin[texts]], begin[: texts + 1])
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top, found

    whole = peak(800)
    monkeypatch.setattr(lm, "LAID_OUT", 1 << 12)
    some = peak(800)
    assert some[0] < 0.5 * whole[0]
    assert all(a == pytest.approx(b, abs=1e-5) for a, b in zip(some[1], whole[1], strict=True))


RELEASED = """
import re
import numpy as np
from sparkevents.llm import lm, subwords

def resident():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1])

encoder, before = subwords.encoder(subwords.vocabulary_bytes()), resident()
for part in range(3):
    words = [f"w{part}x{i:x}" for i in range(120_000)]
    lm.word_pieces(encoder, words, np.arange(len(words)))
full = resident()
del encoder, words
subwords.release()
print(before, full, resident())
"""


@pytest.mark.skipif(sys.platform != "linux", reason="memory is read from /proc")
def test_a_worker_hands_back_the_memory_of_its_encoder():
    found = os.environ | {"PYTHONPATH": os.pathsep.join(filter(None, sys.path))}
    said = subprocess.run([sys.executable, "-c", RELEASED], capture_output=True, text=True, check=True, env=found).stdout
    before, full, after = map(int, said.split())
    assert full - before > 50_000 and after - before < 0.3 * (full - before)


def test_batches_are_small_while_texts_are_scored(spark, monkeypatch):
    name, seen, train = "spark.sql.execution.arrow.maxBytesPerBatch", [], lm.train
    monkeypatch.setattr(lm, "ROUNDS", 0)
    monkeypatch.setattr(lm, "train", lambda *args: seen.append(spark.conf.get(name)) or train(*args))
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, "the cat sat") for i in range(9)], "doc_id long, text string")
    assert lm.score(docs, learnable(7, 2), held_out(7, 2)).count() == 9
    assert seen == [str(lm.BATCH_BYTES)] and spark.conf.get(name) == before
