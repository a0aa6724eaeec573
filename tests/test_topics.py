"""Topic patterns as a trie against their regular expressions, and the plan of the join."""

import random
import re

from sparkevents.operators import filters


def expected(keys, patterns):
    tests = [re.compile(filters.topic_regex(p)) for p in patterns]
    return sorted(k for k in set(keys) if k is not None and any(t.search(k) for t in tests))


def test_random_patterns(spark):
    draw = random.Random(4)
    words = ["a", "b", "c"]
    keys = [".".join(draw.choices(words, k=draw.randrange(1, 7))) for _ in range(300)] + ["a..b", ".a", "a.", "", None, "*", "#", "a.#"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "routing_key string, i int")
    for _ in range(2):
        patterns = [".".join(draw.choices([*words, "*", "#"], k=draw.randrange(1, 6))) for _ in range(12)]
        patterns = [p for p in patterns if p != "#"] or ["a.#"]
        found = filters.subscribe_join(df, filters.pattern_table(spark, patterns))
        assert sorted({r["routing_key"] for r in found.collect()}) == expected(keys, patterns), patterns
        assert found.columns == df.columns
    everything = filters.subscribe_join(df, filters.pattern_table(spark, ["#", "x"]))
    assert everything.count() == len(keys) - 1
    assert filters.subscribe_join(df, filters.pattern_table(spark, ["x"]).limit(0)).count() == 0
    assert filters.subscribe_join(df.limit(0), filters.pattern_table(spark, ["#"])).count() == 0


def test_many_patterns_that_begin_with_a_wildcard(spark):
    patterns = [f"*.w{i}.#" for i in range(5000)] + [f"#.v{i}" for i in range(5000)]
    keys = [f"k{i}.w{i * 7}.x.y" for i in range(1000)] + [f"k.l.v{i * 9}" for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "routing_key string")
    found = filters.subscribe_join(df, filters.pattern_table(spark, patterns))
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()
    wanted = [k for i, k in enumerate(keys) if (i < 1000 and i * 7 < 5000) or (i >= 1000 and (i - 1000) * 9 < 5000)]
    assert sorted(r[0] for r in found.collect()) == sorted(wanted)
