"""The ten queries as they are registered: columns, types, filters and laws of their results over the smallest tables."""

import os
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from cleanloom.llm import common, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

COLUMNS = {
    "op1_ngram_jaccard_join": "doc_id bigint, class_id bigint, n_links bigint",
    "op2_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op3_nearest_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op4_weighted_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint, finish double",
    "op5_ring_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op6_chat_formatting": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_substring_dedup": "doc_id bigint, start_word int, end_word int, removed boolean, cluster_id bigint",
    "op9_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op10_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op11_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12_circulant_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op13_embedding_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
}


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return {i: (x or "") for i, x in zip(t["doc_id"], t["text"], strict=True)}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, texts, name):
    before = spark.conf.get(common.ARROW_ROWS)
    df = queries.queries()[name](spark, SF)
    assert ", ".join(f"{c} {k}" for c, k in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    assert spark.conf.get(common.ARROW_ROWS) == before
    if "doc_id" in df.columns and "piece" not in df.columns and name != "op8_substring_dedup":
        assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    if name == "op2_best_fit_packing":
        assert {r["doc_id"] for r in rows} == set(texts) and max(r["offset"] + r["length"] for r in rows) <= queries.LIMIT
    elif name == "op3_nearest_neighbours":
        assert all(r["query_id"] % 50 == 0 and r["vec_id"] != r["query_id"] for r in rows) and set(Counter(r["query_id"] for r in rows).values()) == {5}
    elif name == "op5_ring_sharding":
        counts = Counter(r["shard"] for r in rows)
        assert {r["law"] for r in rows} == {"rows"} and set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
        assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["grown_shard"] is None for r in rows)
    elif name == "op6_chat_formatting":
        assert -7 in {r["conv_id"] for r in rows} and len({r["conv_id"] for r in rows}) == len(rows)
    elif name == "op7_toxicity":
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    elif name == "op10_token_counts":
        assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from cleanloom import staging

    assert staging.is_local("local") and staging.is_local("local[8]") and not staging.is_local("local-cluster[2,1,1024]") and not staging.is_local("yarn")
    monkeypatch.setattr(staging, "is_local", lambda master: False)
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging.shared_dir(spark)


def test_what_a_query_staged_goes_with_its_scope(spark):
    with common.scratch(spark):
        path = common.stage(spark.range(3), "scope")._staged_at
        assert spark.read.parquet(path).count() == 3
    assert not os.path.exists(path)
