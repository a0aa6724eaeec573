"""The manifest against trees built level by level, proofs folded in plain Python, and the places in the log."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkevents.llm import manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    """All levels of a plain tree."""
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = i // 8 * 8
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        i //= 8
    return out


def by_name(x):
    return (x is not None, (x or "").encode())


def plain(rows):
    """``(group, key, leaf)`` to ``(group, index, leaf, subroot, root, path)``."""
    names = sorted({g for g, _, _ in rows}, key=by_name)
    own = {
        g: sorted(((k, leaf) for h, k, leaf in rows if h == g), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        for g in names
    }
    trees = {g: levels([leaf for _, leaf in own[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    return sorted(
        (
            (g, i, leaf, trees[g][-1][0], top[-1][0], path(trees[g], i) + path(top, n))
            for n, g in enumerate(names)
            for i, (_, leaf) in enumerate(own[g])
        ),
        key=str,
    )


def proved(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, doc_id long, leaf string, carried string").repartition(3)
    found = manifest.proofs(manifest.manifest(df, "lang", ["doc_id"], "leaf", ["doc_id", "carried"]))
    got = [
        (r["group"], r["index"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]])
        for r in found.collect()
    ]
    return sorted(got, key=str)


@pytest.mark.parametrize("count", [1, 2, 8, 9, 64, 65, 512, 513, 700])
def test_positions_are_places_in_the_log(count):
    for most in (manifest.LEVELS, 9):
        high = manifest.levels_of(count, most)
        leaves = [i.to_bytes(32) for i in range(count)]
        log = manifest.build(leaves, high)
        nodes = leaves
        for level in range(high + 1):
            assert [log[p] for p in manifest.position(count, high, level, np.arange(len(nodes)))] == nodes
            nodes = [manifest.above(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        assert len(log) == sum(-(-count // 8**h) for h in range(high + 1))


def test_trees_of_all_sizes_with_ties_and_nulls(spark):
    rows = [("hot", i % 1900, sha(str(i))) for i in range(2100)]
    rows += [(None, i, sha("n", str(i))) for i in range(70)] + [("", None, sha("e")), ("", None, sha("e")), ("", 3, sha("f"))]
    rows += [("é", 1, sha("g")), ("z", 1, sha("h"))] + [(f"l{i}", i, sha("l", str(i))) for i in range(9)]
    rows += [("same", 5, sha("s"))] * 600  # equal rows are spread, too
    assert proved(spark, rows) == plain(rows)


def test_one_leaf_and_no_leaf(spark):
    assert proved(spark, [("a", 1, sha("x"))]) == [("a", 0, sha("x"), sha("x"), sha("x"), [])]
    empty = spark.createDataFrame([], "lang string, doc_id long, leaf string")
    assert manifest.proofs(manifest.manifest(empty, "lang", ["doc_id"], "leaf", ["doc_id"])).count() == 0


def test_fields_and_folding(spark):
    df = spark.createDataFrame([(None, "é", 12), ("", None, None)], "a string, b string, c long")
    got = df.select(*[manifest.field(F.col(c)) for c in "abc"]).collect()
    assert [tuple(r) for r in got] == [("-", "2:é", "2:12"), ("0:", "-", "-")]
    rows = [("g", i, sha(str(i))) for i in range(30)]
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string")
    found = manifest.proofs(manifest.manifest(df, "lang", ["doc_id"], "leaf", ["doc_id"]))
    good = found.select("root", manifest.folded("path", F.col("leaf")).alias("to"), manifest.proof_digest("path").alias("all"), "path")
    for r in good.collect():
        assert r["to"] == r["root"] and r["all"] == sha(*[x for s in r["path"] for x in s])
    bad = found.select("root", manifest.folded("path", F.lit(sha("other"))).alias("to"))
    assert bad.filter("root = to").count() == 0
