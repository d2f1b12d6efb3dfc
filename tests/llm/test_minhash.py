from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from cardledger.llm import minhash
from cardledger.llm.common import connected_components
from cardledger.llm.shingles import shingle_hashes, sorted_sets, word_hashes
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, plain_words, words


def _shingles(text, width=5):
    found = plain_words(text)
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def _plain_classes(texts, similarity=0.8):
    sets = [_shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def _edited(text, seed, edits):
    chance, found = random.Random(seed), text.split()
    for i in range(edits):
        found[chance.randrange(len(found))] = f"edit{seed}x{i}"
    return " ".join(found)


def test_words_and_shingles_match_a_plain_version():
    texts = ["The Cat, the cat; THE dog-9!", "", "Été là... été", "one", "a b c d", "a b c d e f", " -- "]
    hashes, first = word_hashes([t.encode() for t in texts])
    seen: dict[int, str] = {}
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        expected = plain_words(text)
        assert b - a == len(expected)
        for h, word in zip(hashes[a:b].tolist(), expected, strict=True):
            assert seen.setdefault(h, word) == word
    assert len(seen) == len({w for t in texts for w in plain_words(t)})
    values, begins = shingle_hashes(hashes, first, 5)
    assert np.diff(begins).tolist() == [3, 0, 1, 1, 1, 2, 0]
    distinct, counts, start = sorted_sets(*shingle_hashes(*word_hashes([b"a a a a a a a b", b"x"]), 5))
    assert np.diff(start).tolist() == [2, 1] and sorted(counts.tolist()) == [1, 1, 3]


@pytest.mark.parametrize("weighted", [False, True])
def test_signatures_agree_as_often_as_the_sets_are_similar(weighted):
    chance = np.random.default_rng(5)
    elements = np.sort(chance.integers(1, 2**63, 300).astype(np.uint64))
    left, right = elements[:240], elements[60:]
    if weighted:
        weights = chance.uniform(0.2, 3.0, 300)
        left_w, right_w = weights[:240], weights[60:] * 1.3
        low = np.minimum(weights[60:240], weights[60:240] * 1.3).sum()
        high = np.maximum(weights[60:240], weights[60:240] * 1.3).sum() + weights[:60].sum() + (weights[240:] * 1.3).sum()
        similarity = low / high
    else:
        left_w, right_w, similarity = np.ones(240), np.ones(240), 180 / 300
    k = 2000
    signatures = minhash.dart_signatures(
        np.concatenate([left, right]), np.concatenate([left_w, right_w]), np.array([0, 240, 480]), k
    )
    assert abs((signatures[0] == signatures[1]).mean() - similarity) < 0.05
    assert (signatures != 0).all()


def test_a_signature_depends_on_its_set_alone():
    elements = np.arange(1, 60, dtype=np.uint64)
    alone = minhash.dart_signatures(elements, np.ones(59), np.array([0, 59]), 64)
    beside = minhash.dart_signatures(np.concatenate([elements[:3], elements]), np.ones(62), np.array([0, 3, 62]), 64)
    assert (alone[0] == beside[1]).all()


def test_classes_match_brute_force(spark):
    texts = []
    for base in range(12):
        text = words(base, 120, 5000)
        texts += [text, text.upper(), _edited(text, base, 2), _edited(text, base + 50, 3), _edited(text, base + 99, 12)]
    texts += [words(900 + i, 90, 5000) for i in range(20)] + ["", None, "!!", "a b", "A, b", "b a"]
    expected = _plain_classes(texts)
    rows = minhash.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(expected))
    assert {r.doc_id for r in rows if r.kept} == set(expected)
    assert all(r.class_size == expected.count(r.class_id) for r in rows)


def test_a_chain_in_one_bucket_keeps_its_links(spark):
    # Neighbours are similar, the ends are not: a star alone would cut the chain.
    base = words(77, 200, 9000).split()
    texts = []
    for i in range(14):
        base[i * 14] = f"turn{i}"
        texts.append(" ".join(base))
    expected = _plain_classes(texts)
    assert set(expected) == {0}
    rows = minhash.near_duplicates(documents(spark, texts)).collect()
    assert {r.class_id for r in rows} == {0}


def test_large_groups_stay_linear(spark):
    text = words(5, 150, 9000)
    texts = [_edited(text, i, 2) for i in range(120)] + [text] * 200
    rows = minhash.near_duplicates(documents(spark, texts)).collect()
    assert {r.class_id for r in rows} == {0} and sum(r.kept for r in rows) == 1


def _one_bucket(spark, texts, groups=None):
    """Buckets and sets of texts that share one bucket (``groups``: theirs), the first text the most central."""
    sets = minhash.shingle_sets(spark.createDataFrame(list(enumerate(texts)), "node bigint, text string"), 5, False)
    groups = groups or [[0]] * len(texts)
    rows = [(key, i, len(_shingles(t)), 1000 if i == 0 else 10) for i, t in enumerate(texts) for key in groups[i]]
    return spark.createDataFrame(rows, "key bigint, node bigint, size int, company bigint"), sets.cache()


def _labels(found, n):
    return [dict(found).get(i, i) for i in range(n)]


def test_members_apart_from_a_centre_that_lacks_common_words_stay_few_pairs(spark, monkeypatch):
    # The centre's own edit makes it lack what all others share; many are apart from it, some from all.
    text = words(31, 150, 9000)
    texts = [_edited(text, 9000, 1), text] + [_edited(text, seed, edits) for seed, edits in zip(range(300), [1, 3, 6] * 100)]
    compared, verified = [], minhash._verified

    def counted(pairs, sets, similarity):
        compared.append(pairs.select("a", "b").distinct().count())
        return verified(pairs, sets, similarity)

    monkeypatch.setattr(minhash, "_verified", counted)
    labels, _ = minhash._components(*_one_bucket(spark, texts), 0.8)
    assert _labels([(r.node, r.component) for r in labels.collect()], len(texts)) == _plain_classes(texts)
    assert compared[0] == len(texts) - 1 and sum(compared[1:]) <= 2 * len(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_a_bucket_loses_no_link_between_components(spark, seed):
    # Edits, cuts at either end, other texts' passages: sizes and shared parts of all kinds.
    chance = random.Random(seed)
    bases = [words(seed * 100 + i, 80, 9000).split() for i in range(3)]
    texts = []
    for i in range(90):
        found = _edited(" ".join(chance.choice(bases)), seed * 1000 + i, chance.choice([0, 1, 1, 2, 2, 3, 4])).split()
        found = found[chance.choice([0, 0, 6, 12]) : len(found) - chance.choice([0, 0, 6, 12])]
        other = chance.choice(bases)[:30] if chance.random() < 0.3 else []
        texts.append(" ".join(found + other))
    buckets, sets = _one_bucket(spark, texts)
    labels, links = minhash._components(buckets, sets, 0.8)
    assert _labels([(r.node, r.component) for r in labels.collect()], len(texts)) == _plain_classes(texts)
    shingles = [_shingles(t) for t in texts]
    assert all(5 * len(shingles[r.a] & shingles[r.b]) >= 4 * len(shingles[r.a] | shingles[r.b]) for r in links.collect())


def test_near_duplicates_on_odd_rows(spark):
    docs = odd_documents(spark)
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    lines = [r for r in rows if r.class_id == 4]
    assert len(lines) == 3 and sum(r.kept for r in lines) == 1
    wordless = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all(r.kept and r.class_size == 1 for r in wordless)
    kept = minhash.drop_near_copies(clashing(docs, "row", "row_number", "class_id", "text_sha256"))
    assert kept.count() == docs.count() - 2 and kept.columns[:5] == docs.columns
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()
    assert {r.node: r.component for r in found} == (
        dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100) | dict.fromkeys((200, 201, 202), 200)
    )


def test_copies_and_links_are_counted(spark):
    base = words(1, 200, 5000)
    near = base.replace(base.split()[100], "other", 1)
    texts = [base, near, base.upper(), words(2, 150, 5000), "", base]
    rows = {r.doc_id: (r.class_id, r.class_size, r.kept, r.copies, r.links) for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert rows == {
        0: (0, 4, True, 3, 1),
        1: (0, 4, False, 1, 1),
        2: (0, 4, False, 3, 1),
        3: (3, 1, True, 1, 0),
        4: (4, 1, True, 1, 0),
        5: (0, 4, False, 3, 1),
    }
