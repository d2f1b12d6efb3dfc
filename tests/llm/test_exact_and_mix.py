from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cardledger.llm import exact_dedup, mixing
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, words


def _plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(normal.encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {digest: (min(g)[3], len(g)) for digest, g in groups.items()}


def test_groups_match_a_plain_version(spark):
    texts = [words(i % 7, 30) + " " * (i % 5) for i in range(60)] + ["", None, " \x0b", "a b", "ab", "A b"]
    docs = documents(spark, texts)
    expected = _plain_groups(enumerate(texts))
    rows = exact_dedup.digest_groups(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.keep_id, r.group_size) == expected[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)


@pytest.mark.parametrize(("runs", "fan_in"), [(1, 2), (5, 2), (64, 8)])
def test_rounds_do_not_change_the_result(spark, runs, fan_in):
    docs = documents(spark, [words(i % 3, 10) for i in range(40)]).repartition(6)
    rows = exact_dedup.digest_groups(docs, runs=runs, fan_in=fan_in).collect()
    assert Counter(r.keep_id for r in rows) == {0: 14, 1: 13, 2: 13}


def test_exact_dedup_on_odd_rows(spark):
    docs = odd_documents(spark)
    rows = exact_dedup.digest_groups(docs).collect()
    assert len(rows) == docs.count()
    by_digest = defaultdict(list)
    for r in rows:
        by_digest[r.text_sha256].append(r)
    assert all(sum(r.kept for r in g) == 1 for g in by_digest.values())
    lines = next(g for g in by_digest.values() if any(r.doc_id == 4 for r in g))
    assert {r.keep_id for r in lines} == {4} and len(lines) == 3
    kept = exact_dedup.drop_exact_copies(clashing(docs, "row", "row_number", "digest", "best", "run"))
    assert kept.columns[:5] == docs.columns and kept.count() == len(by_digest)
    assert exact_dedup.digest_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def _poisson(u, rate):
    k, term, total = 0, math.exp(-rate), 0.0
    while True:
        total += term
        if total > u or k > 200:
            return k
        k += 1
        term *= rate / k


def test_counts_are_poisson_quantiles(spark):
    docs = documents(spark, [words(i, 5) for i in range(300)])
    mixed = mixing.mix_sources(docs, {"src0": 0.6, "src1": 0.0})
    counts = Counter(r.doc.doc_id for r in mixed.collect())
    rates = {r.source: r.rate for r in mixing.source_rates(docs, {"src0": 0.6, "src1": 0.0}).collect()}
    assert rates == pytest.approx({"src0": 1.8, "src1": 0.0, "src2": 1.2})
    for i in range(300):
        u = int(hashlib.md5(f"{mixing.SEED}|{i}".encode()).hexdigest()[:13], 16) / 2**52
        assert counts[i] == _poisson(u, rates[f"src{i % 3}"])


def test_copies_are_numbered_and_spread(spark):
    docs = documents(spark, [words(i, 5) for i in range(400)])
    rows = mixing.mix_sources(docs, {"src0": 0.9}).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc.doc_id].append((r.copy, r.copies))
    for seen in by_doc.values():
        assert sorted(c for c, _ in seen) == list(range(seen[0][1])) and len({n for _, n in seen}) == 1
    assert abs(sum(r.doc.source == "src0" for r in rows) / len(rows) - 0.9) < 0.08
    order = [r.doc.doc_id for r in rows]
    assert order != sorted(order)


def test_large_rates_do_not_underflow(spark):
    docs = documents(spark, ["a"] * 3 + ["b"] * 2997).withColumn(
        "source", F.when(F.col("doc_id") < 3, "rare").otherwise("rest")
    )
    copies = mixing.mix_sources(docs, {"rare": 0.9}).filter("doc.source = 'rare'").count()
    assert abs(copies - 2700) < 300


def test_mixing_on_odd_rows(spark):
    docs = clashing(odd_documents(spark), "copies", "rate", "steps", "name")
    rows = mixing.mix_sources(docs, {"src2": 0.5}, size=F.length(F.coalesce("text", F.lit(""))) + 1).collect()
    assert rows and all(r.doc["rate"] == "mine" for r in rows)
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA), {"src2": 0.5}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"src0": 0.7, "src1": 0.6})


def test_copies_at_any_rate(spark):
    """The quantile against sums of the distribution, up to rates of a million."""
    from math import exp, lgamma, log

    rates = [0.0, 0.3, 1.0, 7.5, 600.0, 699.9, 700.1, 12_345.6, 1e6]
    drawn = [0.0, 1e-9, 0.1, 0.5, 0.9, 0.999999]
    rows = [(r, u) for r in rates for u in drawn]
    frame = spark.createDataFrame(rows, "rate double, drawn double")
    found = frame.withColumn("copies", mixing.poisson_copies(F.col("rate"), F.col("drawn"))).collect()
    for r in found:
        if not r.rate or not r.drawn:
            assert r.copies == 0
            continue
        low = max(0, int(r.rate - 35 * r.rate**0.5))
        total, k = 0.0, low
        while True:
            total += exp(k * log(r.rate) - r.rate - lgamma(k + 1))
            if total > r.drawn or k > r.rate + 40 * r.rate**0.5 + 60:
                break
            k += 1
        assert abs(r.copies - k) <= (r.rate > 1e5), (r.rate, r.drawn, r.copies, k)
