from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cardledger.llm import quality, toxicity
from cardledger.llm.common import fold_of
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, words

LABELS = "doc_id bigint, quality int, toxic int"


def _best_segments(scores):
    """Maximal segments by the definition: take the best stretch, then look left and right of it."""
    best = max(
        ((sum(scores[a:b]), a - b, -a, a, b) for a, b in itertools.combinations(range(len(scores) + 1), 2)),
        default=(0, 0, 0, 0, 0),
    )
    if best[0] <= 1e-12:
        return []
    a, b = best[3], best[4]
    left = _best_segments(scores[:a])
    right = [(x + b, y + b, s) for x, y, s in _best_segments(scores[b:])]
    return [*left, (a, b - 1, best[0]), *right]


@pytest.mark.parametrize("seed", range(40))
def test_segments_match_the_definition(seed):
    chance = random.Random(seed)
    # Multiples of 1/8 add up exactly, so that ties are ties.
    scores = [chance.choice([-0.25, -0.25, -0.25, 0.125, 0.375, 1.75]) for _ in range(18)]
    positive = [i for i, s in enumerate(scores) if s > 0]
    found = toxicity.maximal_segments(positive, [scores[i] for i in positive])
    expected = _best_segments(scores)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
    assert [s for _, _, s in found] == pytest.approx([s for _, _, s in expected])


def _toxic_table(spark, n=600):
    chance = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        text = words(i, 80).split()
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(3):
                text.insert(chance.randrange(len(text)), chance.choice(["scumbag", "vilex" + str(i % 50), "trashy"]))
        texts.append(" ".join(text))
        labels.append((i, 1, toxic))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS)


def test_toxic_documents_are_found_out_of_sample(spark):
    docs, labels = _toxic_table(spark)
    model = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter(fold_of(F.col("doc_id")) == 0).collect()
    assert len(scored) > 80
    assert sum((r.toxicity.score >= 0.5) == (r.toxic == 1) for r in scored) / len(scored) > 0.97
    hit = next(r for r in scored if r.toxic and r.toxicity.passages)
    span = hit.toxicity.passages[0]
    found = hit.text.split()[span.first_word : span.last_word + 1]
    assert any(w.startswith(("scumbag", "vilex", "trashy")) for w in found)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = _toxic_table(spark)
    turned = labels.withColumn("toxic", F.when(fold_of(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit_toxicity(docs, labels) == toxicity.fit_toxicity(docs, turned)


def test_toxicity_on_odd_rows(spark):
    _, labels = _toxic_table(spark, 60)
    odd = clashing(odd_documents(spark), "toxicity", "score")
    docs, _ = _toxic_table(spark, 60)
    model = toxicity.fit_toxicity(docs.unionByName(odd_documents(spark)), labels.union(spark.createDataFrame([(None, None, None)], LABELS)))
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.toxicity_.score <= 1 and r.toxicity == "mine" for r in rows)
    assert all(r.toxicity_.passages == [] for r in rows if not (r.text or "").strip())
    empty = spark.createDataFrame([], SCHEMA)
    bare = toxicity.fit_toxicity(empty, spark.createDataFrame([], LABELS))
    assert bare.lexicon == {} and toxicity.score_toxicity(empty, bare).count() == 0


def _quality_table(spark, n=500):
    texts, labels = [], []
    for i in range(n):
        good = int(i % 5 != 0)
        texts.append(words(i, 70, 4000) if good else " ".join(["junk***"] * 10 + ["| a |"] * 25))
        labels.append((i, good, 0))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS)


def test_quality_rules_out_of_sample(spark):
    docs, labels = _quality_table(spark)
    scored = quality.score_quality(docs, labels)
    rows = scored.join(labels.drop("toxic").withColumnRenamed("quality", "label"), "doc_id").filter(fold_of(F.col("doc_id")) == 0).collect()
    assert sum((r.quality.score >= 0.3) == (r.label == 1) for r in rows) / len(rows) > 0.97


def test_rules_are_sparse_and_compile_to_what_they_say(spark):
    docs, labels = _quality_table(spark)
    measured = quality.with_statistics(docs, "statistics").select("doc_id", "statistics")
    model = quality.fit_rules(measured, labels)
    assert 0 < len(model.rules) < 120
    rows = measured.select("statistics", quality.rule_score(model, F.col("statistics")).alias("score")).limit(40).collect()
    for r in rows:
        total = model.intercept
        for rule, weight in model.rules:
            values = [(r.statistics[f] <= b) == at_most for f, at_most, b in rule]
            total += weight if all(values) else 0.0
        assert r.score == pytest.approx(1 / (1 + 2.718281828459045**-total))


def test_quality_on_odd_rows(spark):
    docs, labels = _quality_table(spark, 60)
    odd = clashing(odd_documents(spark), "quality", "statistics", "words")
    scored = quality.score_quality(odd, labels)
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r.quality_.score <= 1 and r.quality == "mine" for r in rows)
    empty = quality.score_quality(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS))
    assert empty.count() == 0


def test_a_tail_of_purely_toxic_words_is_learned(spark):
    texts, labels = [], []
    for i in range(4000):
        toxic = int(i % 9 == 0)
        slur = f" {i // 9 % 20:02d}slur" if toxic else ""  # 20 words of some 18 training documents each
        texts.append(words(i, 40) + slur)
        labels.append((i, 1, toxic))
    docs, labels = documents(spark, texts), spark.createDataFrame(labels, LABELS)
    model = toxicity.fit_toxicity(docs, labels)
    assert {f"{k:02d}slur".encode() for k in range(20)} <= set(model.lexicon)
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter(fold_of(F.col("doc_id")) == 0)
    assert scored.filter((F.col("toxicity.score") >= 0.5) != (F.col("toxic") == 1)).count() == 0


@pytest.mark.parametrize("gap", [3, 20])
def test_segments_of_a_hundred_thousand_hits_in_linear_time(gap):
    import time

    positions = list(range(0, 100_000 * gap, gap))
    for scores in ([1.0] * 100_000, [0.3 + i % 7 for i in range(100_000)]):
        start = time.process_time()
        toxicity.maximal_segments(positions, scores)
        assert time.process_time() - start < 1
