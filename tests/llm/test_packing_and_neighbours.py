from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardledger.llm import neighbours, packing
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, words

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_TOKEN]


def _check(rows, texts, tokenizer, capacity=1024):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = _ids(tokenizer, text), 0
        for number, r in enumerate(sorted(pieces[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (number, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            assert number == 0 or r.length == capacity
            at += r.length
        assert at == len(ids)
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_is_a_round_trip_near_the_bound(spark, tokenizer):
    texts = {i: words(i, 30 + 37 * i % 900, 3000) for i in range(160)}
    texts |= {900: "<|endoftext|> é世界  \n\n\t", 901: "", 902: None, 903: "a <|endoftext|> b", 904: "<|endoftext|>" * 1500}
    rows = packing.pack_documents(documents(spark, list(texts.items()))).collect()
    used = _check(rows, texts, tokenizer)
    total = sum(len(_ids(tokenizer, t)) for t in texts.values())
    assert used <= -(-total // 1024) + 2


def test_the_special_token_is_one_id(spark):
    rows = packing.pack_documents(documents(spark, ["a <|endoftext|> b"]), with_ids=True).collect()
    assert [r.ids for r in rows] == [[64, 220, 50256, 275, packing.END_TOKEN]]


def test_whole_sequences_of_many_documents_are_told_apart(spark):
    long = documents(spark, [words(i, 4000, 3000) for i in range(6)]).repartition(3)
    rows = packing.pack_documents(long).collect()
    alone = [r.sequence_id for r in rows if r.length == 1024]
    assert len(alone) > 20 and len(set(alone)) == len(alone)


def test_many_small_shards_and_islands(spark, tokenizer):
    texts = {i: words(i, 20 + 53 * i % 400, 3000) for i in range(120)}
    docs = documents(spark, list(texts.items())).repartition(5)
    rows = packing.pack_documents(docs, shard_pieces=20, islands=3, epochs=3).collect()
    _check(rows, texts, tokenizer)


def test_pieces_carry_their_ids(spark, tokenizer):
    texts = {1: words(1, 900, 3000), 2: "short"}
    for r in packing.pack_documents(documents(spark, list(texts.items())), with_ids=True).collect():
        assert r.ids == _ids(tokenizer, texts[r.doc_id])[r.start : r.start + r.length]


@pytest.mark.parametrize("seed", range(6))
def test_evolution_is_no_worse_than_best_fit(seed):
    # Large pieces, three or so to a bin: the hard case for longest-first best fit.
    chance = np.random.default_rng(seed)
    lengths = np.sort(chance.integers(200, 480, 90))[::-1]
    bound = -(-int(lengths.sum()) // 1000)
    first = packing.best_fit(lengths.tolist(), list(range(90)), 1000, np.full(90, -1))
    best = packing.evolve(lengths, [], seed, 1000, generations=30)[0]
    fill = np.bincount(best, weights=lengths)
    assert (fill > 0).all() and (fill <= 1000).all() and bound <= len(fill) <= first.max() + 1


def test_injected_bins_save_a_bin():
    # 6+4, 6+4, 5+5 fill three bins; best fit in the order 4, 4, 5, 5, 6, 6 needs four.
    lengths = np.array([6, 6, 5, 5, 4, 4])
    poor = packing.best_fit(lengths.tolist(), [4, 5, 2, 3, 0, 1], 10, np.full(6, -1))
    good = np.array([0, 1, 2, 2, 0, 1])
    assert poor.max() == 3
    children = [packing.crossover(lengths, good, poor, list(range(6)), 10, np.random.default_rng(s)) for s in range(8)]
    assert min(c.max() for c in children) == 2


@pytest.mark.parametrize("seed", range(5))
def test_children_keep_every_piece_once_within_capacity(seed):
    chance = np.random.default_rng(seed)
    lengths = np.sort(chance.integers(1, 1024, 200))[::-1]
    order = list(range(200))
    giver = packing.best_fit(lengths.tolist(), order, 1024, np.full(200, -1))
    taker = packing.best_fit(lengths.tolist(), chance.permutation(200).tolist(), 1024, np.full(200, -1))
    child = packing.crossover(lengths, giver, taker, order, 1024, chance)
    fill = np.bincount(child, weights=lengths)
    assert (child >= 0).all() and (fill > 0).all() and (fill <= 1024).all()


def test_packing_on_odd_rows(spark):
    odd = clashing(odd_documents(spark), "row", "length", "piece", "bin")
    rows = packing.pack_documents(odd).collect()
    starts = [r for r in rows if r.piece == 0]
    assert len(starts) == odd.count()
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


VECTORS = "vec_id bigint, embedding array<float>"


def _brute(vectors, query, k):
    own = np.array(vectors[query], dtype=np.float32).astype(float)
    scores = []
    for vec_id, vector in vectors.items():
        if vec_id != query and len(vector) == len(own):
            scores.append((-(np.array(vector, dtype=np.float32).astype(float) * own).sum(), vec_id))
    return sorted(scores)[:k]


@pytest.mark.parametrize(("factor", "least"), [(1.0, 1.0), (neighbours.FACTOR, 0.9), (3.0, 0.4)])
def test_recall_against_brute_force(spark, factor, least):
    chance = np.random.default_rng(2)
    centres = chance.normal(size=(12, 16))
    vectors = {i: (centres[i % 12] + chance.normal(size=16) * 0.4).tolist() for i in range(1500)}
    frame = spark.createDataFrame(list(vectors.items()), VECTORS)
    rows = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=10, factor=factor, shard_rows=400, block_queries=30).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((-r.score, r.vec_id))
    hits = total = 0
    for query, near in found.items():
        expected = _brute(vectors, query, 10)
        hits += len({v for _, v in near} & {v for _, v in expected})
        total += 10
        assert len(near) == 10 and near == sorted(near)
        if factor == 1.0:
            assert [v for _, v in near] == [v for _, v in expected]
    assert len(found) == 75 and hits / total >= least


def test_equal_vectors_go_by_id(spark):
    vectors = [(i, [1.0, 2.0]) for i in range(300)] + [(1000 + i, [0.1 * i, 1.0]) for i in range(50)]
    rows = neighbours.nearest(spark.createDataFrame(vectors, VECTORS), F.col("vec_id") == 40, k=5, shard_rows=100).collect()
    assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"])] == [1049, 1048, 1047, 1046, 1045]
    rows = neighbours.nearest(spark.createDataFrame(vectors[:300], VECTORS), F.col("vec_id") == 3, k=5).collect()
    assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"])] == [0, 1, 2, 4, 5]


def test_equal_scores_of_different_vectors_go_by_id(spark):
    vectors = [(0, [1.0, 0.0])] + [(i, [1.0, float(i)]) for i in range(1, 402)]
    rows = neighbours.nearest(spark.createDataFrame(vectors, VECTORS), F.col("vec_id") == 0, k=5, factor=1.0, shard_rows=150).collect()
    assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("length", [1e8, 1e160, 1e300, 1e-200])
def test_one_vector_of_another_magnitude(spark, length):
    chance = np.random.default_rng(4)
    vectors = {i: v.tolist() for i, v in enumerate(chance.normal(size=(1500, 8)))}
    vectors[777] = (np.array(vectors[777]) * length).tolist()
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    rows = neighbours.nearest(frame, F.col("vec_id").isin(0, 100, 777), k=20, factor=1.0, shard_rows=500).collect()
    with np.errstate(over="ignore"):
        for query in (0, 100, 777):
            own = np.array(vectors[query])
            near = sorted((-(np.array(v) * own).sum(), i) for i, v in vectors.items() if i != query)[:20]
            found = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == query)
            assert [(i, -s) for s, i in near] == [(i, s) for _, i, s in found]


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_at_full_shards(clusters):
    """8,192 rows of 64 dimensions in one tree, at the production factor."""
    chance = np.random.default_rng(9)
    rows = chance.normal(size=(8192, 64))
    if clusters:
        rows = chance.normal(size=(clusters, 64))[chance.integers(clusters, size=8192)] + rows * 0.3
    ids = np.arange(8192)
    asked = neighbours.Queries(ids[::64], rows[::64], rows, ids, 20)
    neighbours.VantageTree(asked.lifted).search(asked, neighbours.FACTOR)
    exact = rows[::64] @ rows.T
    exact[np.arange(128), ids[::64]] = -np.inf
    expected = np.argsort(-exact, axis=1)[:, :20]
    hits = sum(len({*a} & {*b}) for a, b in zip(expected.tolist(), asked.found.tolist(), strict=True))
    assert hits / expected.size >= 0.95


def test_neighbours_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.0]),
        (0, [1.0, 0.0]),
        (1, None),
        (2, [0.0, 0.0]),
        (3, [nan, 1.0]),
        (4, [inf, 1.0]),
        (5, [None, 1.0]),
        (6, [2.0, 1.0]),
        (7, [-1.0, -0.0]),
        (8, [1.0, 1.0, 1.0]),
        (9, []),
        (None, [1.0, 1.0]),
    ]
    frame = clashing(spark.createDataFrame(vectors, VECTORS), "vector", "shard", "rank")
    rows = neighbours.nearest(frame, F.lit(True)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows) == [
        (0, 1, 6, 2.0),
        (0, 2, 7, -1.0),
        (6, 1, 0, 2.0),
        (6, 2, 0, 2.0),
        (6, 3, 7, -2.0),
        (7, 1, 0, -1.0),
        (7, 2, 0, -1.0),
        (7, 3, 6, -2.0),
    ]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0
