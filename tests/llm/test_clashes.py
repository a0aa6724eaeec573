"""Tables that already have columns with the names of helpers."""

from conftest import rows
from pyspark.sql import functions as F

from sparkevents.llm import mixing, simhash

HELPERS = [
    "target", "source_size", "groups", "before", "of", "s_", "z_", "g_", "k_", "n", "bin", "copies", "taken", "size", "copy_", "c0_",
    "kept_id", "kept_hash", "root", "fingerprint", "component_id", "low", "u", "v", "m", "text_hash", "rank_key", "source_key",
]


def test_mixing_and_dedup_with_columns_of_all_helpers(spark):
    data = [(i, f"s{i % 3}", " ".join(["w"] * (i % 7)) + f" x{i // 2}") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string")
    wide = docs.withColumns({c: F.lit(c) for c in HELPERS})
    assert rows(mixing.emit(wide).select(docs.columns)) == rows(mixing.emit(docs))
    assert mixing.emit(wide).columns == wide.columns
    assert rows(mixing.mix(wide).select("doc_id", "mix")) == rows(mixing.mix(docs).select("doc_id", "mix"))
    found = simhash.deduplicated(wide)
    assert found.columns == wide.columns and rows(found.select(docs.columns)) == rows(simhash.deduplicated(docs))
    assert all(r["target"] == "target" and r["kept_id"] == "kept_id" for r in found.collect())
