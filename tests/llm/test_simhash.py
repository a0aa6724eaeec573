"""SimHash fingerprints and components against plain Python."""

import random

import xxhash
from conftest import rows
from sparkevents.llm import simhash
from sparkevents.llm.common import components


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return bits


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_components(values, radius):
    parent = list(range(len(values)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def test_fingerprints():
    texts = ["", None, " \n", "One", "one TWO", "a b c", "A b\tc d e f É g", "x y z " * 70_000, "Ä ä b"]
    assert [simhash.fingerprint(t) & (1 << 64) - 1 for t in texts] == [plain(t) for t in texts]
    assert simhash.fingerprint("Ä b c") != simhash.fingerprint("ä b c")  # only A-Z are lower-cased


def test_links_connect_what_all_pairs_connect(spark):
    draw = random.Random(4)
    values = [draw.getrandbits(64) for _ in range(150)]
    for _ in range(350):
        x = draw.choice(values)
        for _ in range(draw.randint(1, 4)):
            x ^= 1 << draw.randrange(64)
        values.append(x)
    values = list(dict.fromkeys([*values, 0, 1, 7, 15, (1 << 64) - 1]))
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    expected = plain_components(values, 3)
    for tile in (4096, 3):
        found = dict(rows(components(simhash.links(frame, 3, tile))))
        got = {}
        for v, top in zip(values, expected):
            got.setdefault(found.get(signed(v), signed(v)), set()).add(top)
        assert all(len(x) == 1 for x in got.values()) and len(got) == len(set(expected))


def test_large_near_group_gives_few_edges(spark):
    values = [1 << a | 1 << b for a in range(40) for b in range(a)]  # each within four bits of every other
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fingerprint long"), 4)
    assert found.count() < 8 * len(values)


def test_rows_of_documents(spark):
    base = " ".join(f"w{i}" for i in range(300))
    data = [
        (5, base, "a"), (3, base, "b"), (3, base, "b"), (9, base + " end", "c"), (1, "other words here", "d"),
        (None, "other words here", "e"), (20, None, "f"), (21, "", "g"), (22, " \t", "h"), (None, "all alone at last", "i"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, component_id string")
    found = rows(simhash.near_duplicates(docs).select("doc_id", "component_id"))
    assert (3, 3) in found and found.count((3, 3)) == 2 and (5, 3) in found
    assert {(20, 20), (21, 20), (22, 20), (1, 1), (None, 1), (None, None)} <= set(found) and len(found) == 10
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    left = rows(kept.select("doc_id"))
    near = simhash.fingerprint(base) ^ simhash.fingerprint(base + " end")
    linked = bin(near & (1 << 64) - 1).count("1") <= 3
    assert left == sorted([(1,), (3,), (20,), (None,), *([] if linked else [(9,)])], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.deduplicated(docs.limit(0)).count() == 0


def test_unrelated_texts_without_an_id_or_with_one_id_stay(spark):
    texts = [" ".join(f"{name}{i}" for i in range(200)) for name in "pqrst"]
    data = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3]), (7, texts[4])]
    kept = simhash.deduplicated(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(kept) == sorted([(None, texts[0]), (None, texts[1]), *[(7, t) for t in texts[2:]]], key=str)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2000, 2000), (3, 1)]
    found = dict(rows(components(spark.createDataFrame(edges, "u long, v long"))))
    assert found == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 200)}}
