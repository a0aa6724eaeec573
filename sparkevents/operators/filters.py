"""Subscriptions, routing by content type, and the error branch."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import keep
from ..functions.variants import MESSAGE
from ..session import written

# Setting -> routing keys it stands for.
SUBSCRIPTION_GROUPS = {
    "events_watchlist": ["watchlist.#"],
    "events_feed": ["feed.#"],
    "events_alert": ["alert.#"],
    "events_raw_sensor": [
        "ingress.event.process", "ingress.event.procstart", "ingress.event.netconn", "ingress.event.procend",
        "ingress.event.childproc", "ingress.event.moduleload", "ingress.event.module", "ingress.event.filemod",
        "ingress.event.regmod", "ingress.event.tamper", "ingress.event.crossprocopen", "ingress.event.remotethread",
        "ingress.event.processblock", "ingress.event.emetmitigation", "ingress.event.filelessscriptload",
    ],
    "events_binary_observed": ["binaryinfo.#"],
    "events_binary_upload": ["binarystore.#"],
    "events_storage_partition": ["events.partition.#"],
    "task_errors": ["task.error.logged"],
}

RAW_EXCHANGE = "api.rawsensordata"


def parse_subscriptions(conf: dict[str, str]) -> list[str]:
    """Routing-key patterns of a configuration: ``all`` means the whole group, ``0`` nothing, else a comma list."""
    patterns: list[str] = []
    for group, members in SUBSCRIPTION_GROUPS.items():
        value = conf.get(group, "0").lower()
        if value == "all":
            patterns += members
        elif value != "0":
            patterns += value.split(",")
    return patterns


def topic_regex(pattern: str) -> str:
    """Anchored regex of a topic pattern: ``*`` is one word, ``#`` any number of words including none."""
    words = pattern.split(".")
    if words == ["#"]:
        return "^.*$"
    out = ""
    for i, w in enumerate(words):
        if w == "#":
            out += r"(?:[^.]+(?:\.|$))*" if i == 0 else r"(?:\.[^.]+)*"
        else:
            dot = "" if i == 0 or (i == 1 and words[0] == "#") else r"\."
            out += dot + (r"[^.]+" if w == "*" else re.escape(w))
    return f"^{out}$"


def pattern_table(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """Patterns as a table with the regex and the first word of each."""
    rows = [(p, topic_regex(p), p.split(".")[0]) for p in dict.fromkeys(patterns)]
    return spark.createDataFrame(rows, "pattern string, regex string, first_word string")


def matches_any(routing_key: Column, patterns: list[str]) -> Column:
    """Whether a routing key matches one of the patterns: exact keys by set lookup, the rest by one alternation."""
    exact = [p for p in patterns if not re.search(r"[*#]", p)]
    wild = [topic_regex(p) for p in patterns if re.search(r"[*#]", p)]
    hit = routing_key.isin(*exact) if exact else F.lit(False)
    return hit | routing_key.rlike("|".join(wild)) if wild else hit


def subscribe_filter(df: DataFrame, patterns: list[str]) -> DataFrame:
    """Keep messages whose routing key matches a pattern."""
    return df.filter(matches_any(F.col("routing_key"), patterns))


def topic_trie(patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns as a trie: edges ``(node, word, next)``, and ``(node, to)`` for all nodes that are reached from a node without
    a word, itself included. A node is named by the words that lead to it; the root is empty."""
    words = F.split("pattern", r"\.")
    step = F.posexplode(words).alias("at", "word")
    steps = patterns.select("pattern", words.alias("words"), step)
    prefix = lambda n: F.array_join(F.slice("words", 1, n), ".")
    edges = steps.select(
        F.when(F.col("at") == 0, F.lit("")).otherwise(prefix(F.col("at"))).alias("node"), "word", prefix(F.col("at") + 1).alias("next")
    ).distinct()
    # a node leads on by the run of ``#`` edges behind it
    hashes = F.expr("size(filter(words, (w, i) -> i >= at and forall(slice(words, at + 1, i - at + 1), x -> x = '#')))")
    runs = steps.filter("word = '#'").select(
        F.when(F.col("at") == 0, F.lit("")).otherwise(prefix(F.col("at"))).alias("node"), "words", "at", hashes.alias("run")
    )
    runs = runs.select("node", F.explode(F.transform(F.sequence(F.lit(1), "run"), lambda n: prefix(F.col("at") + n))).alias("to"))
    nodes = edges.select("next").union(edges.select("node")).distinct()
    return edges, runs.union(nodes.select("next", "next")).distinct()


def matching_keys(keys: DataFrame, patterns: DataFrame) -> DataFrame:
    """The routing keys (a column ``routing_key`` without repeats) that match a pattern, by walking all of them through the
    trie at once: one equi join per word of the longest key, on a node and a word."""
    edges, free = (written(part, "trie") for part in topic_trie(patterns.select("pattern").distinct()))
    words = F.split("routing_key", r"\.")
    longest = keys.agg(F.max(F.size(words))).first()[0] or 0
    ends = patterns.select(F.col("pattern").alias("node")).distinct()
    keys = written(keys.filter("routing_key IS NOT NULL"), "topics")
    # all keys begin at the root and behind the run of ``#`` that patterns begin with, no longer than a pattern
    roots = [r["to"] for r in free.filter("node = ''").select("to").collect()] or [""]
    states = keys.withColumn("node", F.explode(F.array(*[F.lit(r) for r in roots])))
    free = free.withColumnsRenamed({"node": "of"})
    everything = not patterns.filter("pattern = '#'").isEmpty()
    found = keys.filter(F.lit(everything))
    for at in range(longest + 1):
        if at:
            states = states.join(free, F.col("node") == F.col("of")).select("routing_key", F.col("to").alias("node")).distinct()
        if at % 4 == 3:  # the plan starts anew from a table
            states = written(states, "topics")
        found = found.union(states.filter(F.size(words) == at).join(ends, "node", "left_semi").select("routing_key"))
        word = F.get(words, F.lit(at))
        going = states.filter(F.size(words) > at).withColumn("word", word)
        ways = F.array(F.col("word"), F.when(F.col("word") != "", F.lit("*")))
        over = going.select("routing_key", "node", F.explode(ways).alias("word")).filter("word NOT IN ('#')").join(edges, ["node", "word"])
        stay = going.filter((F.substring_index("node", ".", -1) == "#") & (F.col("word") != "")).select("routing_key", "node")
        states = over.select("routing_key", F.col("next").alias("node")).union(stay)
    return found.distinct()


def subscribe_join(df: DataFrame, patterns: DataFrame) -> DataFrame:
    """Semi join of messages to a table of topic patterns (column ``pattern``).

    The distinct routing keys are matched (``matching_keys``), so the work grows with the keys and not with their product
    with the patterns, wherever the wildcards are. For a stream, or few patterns, take ``subscribe_filter``.
    """
    keys = df.select("routing_key").distinct()
    return df.join(matching_keys(keys, patterns), "routing_key", "left_semi").select(*df.columns)


def dispatch_content_type(df: DataFrame, raw_exchange: str = RAW_EXCHANGE, out: str = "route") -> DataFrame:
    """Processing path of a message: ``bundle``, ``single`` or ``json``; NULL route and an error otherwise."""
    kind = F.col("content_type")
    route = (
        F.when(kind == "application/zip", "bundle")
        .when((kind == "application/protobuf") & (F.col("exchange") == raw_exchange), "bundle")
        .when(kind == "application/protobuf", "single")
        .when(kind == "application/json", "json")
    )
    previous = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.select(
        *[c for c in df.columns if c != "error"],
        route.alias(out),
        F.coalesce(previous, F.when(route.isNull(), F.lit("unknown content type"))).alias("error"),
    )


def parse_json_body(df: DataFrame) -> DataFrame:
    """Body text to message map; a malformed or non-object body becomes an error row instead of failing the job.

    Numbers whose text parsing would change are kept as they came (``functions.numbers``)."""
    msg = F.from_json(keep(F.col("body").cast("string")), MESSAGE)
    previous = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    # a generator of one row keeps filters on the result above it, so the body is parsed once
    one = F.explode(F.array(F.struct(F.when(previous.isNull(), msg).alias("msg")))).alias("_parsed")
    parsed = df.select(*[c for c in df.columns if c != "msg"], one)
    return parsed.select(
        *[c for c in df.columns if c not in ("error", "msg")],
        F.col("_parsed.msg").alias("msg"),
        F.coalesce(previous, F.when(F.col("_parsed.msg").isNull(), F.lit("body is not a JSON object"))).alias("error"),
    )


def nonempty_filter(df: DataFrame, text: str = "value") -> DataFrame:
    """Empty or missing text is not output."""
    return df.filter(F.length(text) > 0)


def reject_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows, error rows)``; the stream goes on with the first."""
    return df.filter(F.col("error").isNull()).drop("error"), df.filter(F.col("error").isNotNull())


def error_counts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNotNull()).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All sources in one output channel; columns a source lacks are NULL."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first
