"""The pipeline's stages against plain Python, and the queries' SQL on the smallest tables."""

import os

import duckdb
import pytest
from conftest import rows

import corpus_pipeline
from sparkevents.llm import queries, secrets, simhash, toxicity
from sparkevents.llm.common import learnable, materialize, table

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage leaves of the documents."""
    docs, found = table(spark, LARGER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, LARGER), name)
        found.append(docs)
    return [table(spark, LARGER, "documents"), *found]


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stage_names_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_dedup", "secret_scan", "source_mixing", "best_fit_packing",
    ]
    assert all(df.columns == kept[0].columns for df in kept[:-1])


def test_toxicity_drops_what_it_predicts(spark, kept):
    model = toxicity.train(kept[0], table(spark, LARGER, "labels"), learnable(3, 1))
    scored = toxicity.score(kept[0].select("doc_id", "text"), model).collect()
    assert rows(kept[1].select("doc_id")) == sorted([(r["doc_id"],) for r in scored if r["score"] < 0.7], key=str)
    labels = dict(rows(table(spark, LARGER, "labels").select("doc_id", "toxic")))
    dropped = set(texts(kept[0])) - set(texts(kept[1]))
    assert sum(labels.get(i, 1) == 0 for i in dropped) <= 0.01 * len(labels)


def test_simhash_keeps_the_smallest_of_each_group(kept):
    prints = {i: simhash.fingerprint(t) & (1 << 64) - 1 for i, t in texts(kept[1]).items()}
    parent = {i: i for i in prints}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if b < a and bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    assert sorted(texts(kept[2])) == sorted({top(i) for i in ids})


def test_secrets_are_replaced_and_clean_texts_kept(kept):
    before, after = texts(kept[2]), texts(kept[3])
    assert before.keys() == after.keys()
    assert any(secrets.base_spans(t) for t in before.values())
    for i, text in after.items():
        assert not secrets.base_spans(text)
        assert text == before[i] or secrets.PLACEHOLDER in text


def test_mixing_repeats_whole_documents(kept):
    assert {(r["doc_id"], r["text"]) for r in kept[4].collect()} <= {(r["doc_id"], r["text"]) for r in kept[3].collect()}
    assert kept[4].groupBy("doc_id").count().filter("count > 3").count() == 0


def test_packing_holds_every_document(kept):
    pieces = kept[5].toPandas()
    begun = pieces[pieces["piece"] == 0]["doc_id"].value_counts().to_dict()
    assert begun == {r["doc_id"]: r["count"] for r in kept[4].groupBy("doc_id").count().collect()}
    assert pieces.groupby("sequence_id")["length"].sum().max() <= 1024


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert rows(queries.QUERIES[name](spark, SF_DIR), *columns) == sorted(result.fetchall(), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op8_lm_scoring"}))
def test_whole_table(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    ids = [r["doc_id"] for r in df.select("doc_id").collect()]
    assert set(ids) == set(texts(table(spark, SF_DIR, "documents")))
    assert len(ids) == len(set(ids)) or name == "op2_best_fit_packing"
