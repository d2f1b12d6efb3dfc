"""The registered queries on the smallest tables: statements agree, contract columns are there, stages chain."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardledger.llm.catalogue import QUERIES, oracle_statements
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, words

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

CONTRACT = {
    "op2_toxic_segments": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_rule_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_vantage_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op6_grouping_pack": {
        "doc_id": "bigint",
        "piece": "int",
        "start": "bigint",
        "length": "bigint",
        "ids_crc32": "bigint",
        "sequence_id": "bigint",
        "offset": "bigint",
    },
    "op10_ppm_score": {
        "doc_id": "bigint",
        "held_out": "boolean",
        "n_tokens": "bigint",
        "n_known": "bigint",
        "train_tokens": "bigint",
        "base_score": "double",
        "score": "double",
    },
    "op11_benchmark_phrases": {
        "doc_id": "bigint",
        "n_words": "bigint",
        "n_hit": "bigint",
        "n_items": "bigint",
        "items_sha256": "string",
        "contaminated": "boolean",
    },
    "op12_aligned_tokens": {
        **dict.fromkeys(("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint"),
        "groups_sha256": "string",
    },
    "op13_whitened_vectors": {
        "vec_id": "bigint",
        "component": "int",
        "n": "bigint",
        "deviation": "bigint",
        **dict.fromkeys(("whitened", "explained", "identity_error"), "double"),
    },
}


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_statements()))
def test_query_against_its_statement(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    duck.execute(oracle_statements()[name])
    columns = [d[0] for d in duck.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted(repr([row[columns.index(c)] for c in frame.columns]) for row in duck.fetchall())
    assert sorted(repr(list(row)) for row in frame.collect()) == expected and expected


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    types = dict(frame.dtypes)
    assert {c: types[c] for c in CONTRACT[name]} == CONTRACT[name]
    assert frame.count() > 0


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def _stages(spark, docs, tmp_path, sf_dir):
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
    return kept


@pytest.fixture
def labelled(spark, tmp_path):
    """A data set: toxic documents, exact and near copies, and clean texts of three sources."""
    texts, labels = [], []
    for i in range(240):
        toxic = int(i % 8 == 0)
        text = words(i, 120, 4000)
        texts.append(f"{text} vilestword {text[:40]} awfulname hatefulthing" if toxic else text)
        labels.append((i, 1, toxic))
    copies = [texts[1], texts[1].replace(" ", "  "), texts[2].upper(), texts[3] + " one more word here", None, "", ""]
    docs = documents(spark, [*texts, *copies])
    folder = str(tmp_path / "data")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_stages_do_what_they_say(spark, labelled, tmp_path):
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    kept = _stages(spark, docs, tmp_path / "s", labelled)
    ids = {name: {r.doc_id for r in frame.select("doc_id").collect()} for name, frame in kept.items()}
    toxic = {i for i in range(240) if i % 8 == 0}
    everything = set(range(247))
    assert ids["toxicity"] == everything - toxic
    # 241 has more characters than 1 and 240; of the empty texts the first stays.
    assert ids["exact_dedup"] == everything - toxic - {1, 240} - {245, 246}
    # 242 and 243 are near copies of 2 and 3.
    assert ids["near_dedup"] == ids["exact_dedup"] - {242, 243}
    assert ids["source_mix"] <= ids["near_dedup"] and ids["packing"] == ids["source_mix"]
    for name in ("toxicity", "exact_dedup", "near_dedup", "source_mix"):
        assert kept[name].columns == docs.columns
    pieces = kept["packing"].filter("piece = 0").count()
    assert pieces == kept["source_mix"].count()
    full = kept["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert full.filter("n > 1024").count() == 0


def test_pipeline_takes_odd_rows_extra_columns_and_nothing(spark, labelled, tmp_path):
    odd = clashing(odd_documents(spark), "row", "toxicity", "row_number", "copies", "score")
    kept = _stages(spark, odd, tmp_path / "odd", labelled)
    assert kept["toxicity"].count() == odd.count() and kept["source_mix"].columns == odd.columns
    assert kept["near_dedup"].count() == 5
    empty = _stages(spark, spark.createDataFrame([], SCHEMA), tmp_path / "none", labelled)
    assert all(frame.count() == 0 for frame in empty.values())
