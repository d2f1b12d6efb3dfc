from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardledger.llm import licenses, passages, ppm
from cardledger.llm.common import fold_of
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, plain_words, words


def _plain_passages(texts, n=50):
    """(doc, first, end) of merged stretches of n words that another document holds."""
    split = [plain_words(t) for t in texts]
    holders: dict[tuple, set[int]] = {}
    for i, found in enumerate(split):
        for a in range(len(found) - n + 1):
            holders.setdefault(tuple(found[a : a + n]), set()).add(i)
    spans = []
    for i, found in enumerate(split):
        at = [a for a in range(len(found) - n + 1) if len(holders[tuple(found[a : a + n])]) > 1]
        merged: list[list[int]] = []
        for a in at:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = a + n
            else:
                merged.append([a, a + n])
        spans += [(i, a, b) for a, b in merged]
    return set(spans)


def _found(frame):
    return {(r.doc_id, r.first_word, r.end_word) for r in frame.collect()}


def test_planted_passages_match_brute_force(spark):
    chance = random.Random(9)
    shared = [words(500 + i, 50 + 9 * i, 9000) for i in range(6)]
    texts = []
    for i in range(60):
        found = words(i, 150 + i, 9000).split()
        if i % 2:
            at = chance.randrange(len(found))
            found[at:at] = shared[chance.randrange(6)].split()
        texts.append(" ".join(found))
    texts += [texts[0], texts[1].upper(), " ".join(texts[2].split()[:49]), shared[0]]
    expected = _plain_passages(texts)
    assert len(expected) > 30
    assert _found(passages.repeated_passages(documents(spark, texts))) == expected


def test_a_passage_shorter_than_the_least_is_left(spark):
    shared = words(1, 49, 9000)
    texts = [f"{words(10 + i, 80, 9000)} {shared} {words(40 + i, 80, 9000)}" for i in range(6)]
    assert _found(passages.repeated_passages(documents(spark, texts))) == set()


def test_many_edited_copies(spark):
    base = words(3, 400, 9000).split()
    texts = []
    for i in range(80):
        chance, found = random.Random(i), list(base)
        for _ in range(3):
            found[chance.randrange(400)] = f"own{i}"
        texts.append(" ".join(found))
    expected = {(d, w) for d, a, b in _plain_passages(texts) for w in range(a, b)}
    seen = {(d, w) for d, a, b in _found(passages.repeated_passages(documents(spark, texts).repartition(6))) for w in range(a, b)}
    assert seen == expected


def test_a_passage_between_longer_matches_of_other_texts(spark):
    """Two texts share 52 words; others follow or precede either one further, but share only 49 with it."""
    texts, pairs = [], []
    for i in range(12):
        chance = random.Random(100 + i)
        shared = words(1000 + i, 52, 9000).split()
        for side in range(2):
            front, back = (words(2000 + 10 * i + 5 * side + k, 60, 9000).split() for k in range(2))
            pairs.append(len(texts))
            texts.append(front + shared + back)
            for _ in range(6):
                kept = chance.randrange(20, 45)
                own = [words(chance.randrange(10**6), 20, 9000).split() for _ in range(4)]
                texts.append(own[0] + front[kept - 49 :] + shared[:kept] + own[1])
                texts.append(own[2] + shared[-kept:] + back[: 49 - kept] + own[3])
    texts = [" ".join(found) for found in texts]
    expected = _plain_passages(texts)
    assert set(pairs) <= {doc for doc, _, _ in expected}
    for partitions in (1, 5):
        assert _found(passages.repeated_passages(documents(spark, texts).repartition(partitions))) == expected


def test_one_word_over_and_over(spark):
    texts = ["again " * 300, "again " * 200, f"{words(1, 40, 9000)} {'again ' * 55}{words(2, 40, 9000)}", "again " * 49, "a b " * 120, "b a " * 90]
    assert _found(passages.repeated_passages(documents(spark, texts))) == _plain_passages(texts)


def test_partners_are_real(spark):
    shared = words(1, 70, 9000)
    texts = {7: f"a b c {shared}", 3: f"{shared} x y", 5: words(2, 100, 9000)}
    rows = passages.repeated_passages(documents(spark, list(texts.items()))).collect()
    assert {(r.doc_id, r.first_word, r.end_word, r.words, r.partner_id) for r in rows} == {(7, 3, 73, 70, 3), (3, 0, 70, 70, 7)}


def test_passages_on_odd_rows(spark):
    docs = clashing(odd_documents(spark), "row", "seed", "at", "left")
    assert passages.repeated_passages(docs).count() == 0
    twice = docs.union(docs)
    rows = passages.repeated_passages(twice).collect()
    assert {(r.doc_id, r.words) for r in rows} == {(6, 60_000)} and len(rows) == 2
    same = documents(spark, ["again " * 300, "again " * 200, "once more"])
    assert {r.doc_id for r in passages.repeated_passages(same).collect()} == {0, 1}
    assert passages.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def _plain_licenses(text):
    found = plain_words(text)
    starts, base, met, best = [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(found) - len(parts) + 1):
            if found[i : i + len(parts)] == parts:
                starts.append(i)
                base.add(label)
    for at in range(max(len(found) - licenses.BLOCK_WORDS, 0) + 1):
        block = set(found[at : at + licenses.BLOCK_WORDS])
        for label, template in licenses.TEMPLATES.items():
            held = set(template.split())
            share = len(held & block) / len(held)
            if share >= licenses.THRESHOLD:
                met.add(label)
                best = max(best, share)
    return (
        len(found),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | met)),
        1.0 if starts else best,
    )


def _license_rows(frame):
    return [tuple(r.license)[:7] for r in frame.orderBy("n").select("license").collect()]


def test_license_scan_matches_brute_force(spark):
    chance = random.Random(4)
    texts = [
        "Released under the MIT License.",
        "cc by nc cc BY-NC; under-the-mit/license under the mit licensed",
        "Apache License, Version 2.0 and Apache\nLicense\nVersion 2",
        "",
        "Under The MiK License İ under the mit license",
    ]
    for i in range(60):
        template = chance.choice(list(licenses.TEMPLATES.values())).split()
        chance.shuffle(template)
        cut = template[: chance.randrange(len(template) + 1)]
        texts.append(" ".join([words(i, chance.randrange(60)), *cut, words(i + 99, chance.randrange(60))]))
    docs = documents(spark, texts).withColumn("n", F.col("doc_id"))
    assert _license_rows(licenses.license_scan(docs)) == [_plain_licenses(t) for t in texts]


def test_blocks_are_found_at_every_word(spark):
    """The wording with 3 of its inner words replaced, and the wording spread over 24 words, wherever they start."""
    gpl = licenses.TEMPLATES["gpl"].split()
    worn = [w if i not in (4, 9, 13) else f"other{i}" for i, w in enumerate(gpl)]
    spread = [w for i, w in enumerate(gpl) for w in ([w, f"between{i}"] if i % 3 == 2 else [w])]
    texts = [" ".join([words(1, at, 50), *wording, words(2, 70, 50)]) for at in range(34) for wording in (worn, spread)]
    texts += [" ".join([*(["gpl", "general", "public"] * 200), *gpl, *(["license"] * 100)]), " ".join(gpl * 3), " ".join(gpl[:16])]
    docs = documents(spark, texts).withColumn("n", F.col("doc_id"))
    found = licenses.license_scan(docs)
    assert all("gpl" in r.license.labels for r in found.collect())
    assert _license_rows(found) == [_plain_licenses(t) for t in texts]
    blocks = {r.doc_id: sum(b.blocks for b in r.license.blocks if b.label == "gpl") for r in found.collect()}
    held = set(gpl)
    for i, text in enumerate(texts):
        w = plain_words(text)
        starts = range(max(len(w) - licenses.BLOCK_WORDS, 0) + 1)
        assert blocks[i] == sum(len(held & set(w[at : at + licenses.BLOCK_WORDS])) >= 0.8 * len(held) for at in starts)


def test_only_what_is_asked_for_is_kept(spark):
    docs = documents(spark, ["permission is granted"])
    assert licenses.license_scan(docs, keep=("doc_id",)).columns == ["doc_id", "license"]
    assert licenses.license_scan(docs, templates={}).first().license.labels == ""


def test_any_order_gives_the_same_join(spark):
    texts = [t + " and more" for t in licenses.TEMPLATES.values()]
    docs = documents(spark, texts).withColumn("n", F.col("doc_id"))
    turned = {w: -i for i, w in enumerate(sorted({w for t in licenses.TEMPLATES.values() for w in t.split()}))}
    assert _license_rows(licenses.license_scan(docs, order=turned)) == _license_rows(licenses.license_scan(docs))


def test_license_scan_on_odd_rows(spark):
    docs = clashing(odd_documents(spark), "license", "words", "license_words", "blocks")
    rows = licenses.license_scan(docs).collect()
    assert len(rows) == docs.count() and all(r.license == "mine" and r.license_.labels == "" for r in rows)
    assert licenses.license_scan(spark.createDataFrame([], SCHEMA)).count() == 0


def _plain_base(texts, training):
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    counts = Counter(w for own, used in zip(tokens, training, strict=True) if used for w in own)
    total = sum(counts.values())
    return [
        (
            len(own),
            sum(counts[w] > 0 for w in own),
            total,
            sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own),
        )
        for own in tokens
    ]


def test_base_scores_match_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(ppm, "HEAD_WORDS", 50)  # most words take the join
    texts = [words(i, 10 + i, 300) for i in range(60)] + ["", None, "New word KK \x0b\x1c end", "W1 w1 W1"]
    docs = documents(spark, texts)
    training = [bool(r.t) for r in docs.select((fold_of(F.col("doc_id")) != 1).alias("t")).collect()]
    rows = sorted(ppm.score_texts(docs, fold_of(F.col("doc_id")) != 1).collect(), key=lambda r: r.doc_id)
    for r, expected in zip(rows, _plain_base(texts, training), strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[:3]
        assert r.base_score == pytest.approx(expected[3], rel=1e-12)


def _followers(counts):
    found: dict[bytes, Counter] = {}
    for word, n in counts.items():
        path = b" " + word + b" "
        for i in range(1, len(path)):
            for order in range(min(ppm.ORDER, i) + 1):
                found.setdefault(path[i - order : i], Counter())[path[i]] += n
    return {c: dict(f) for c, f in found.items()}


def test_the_trie_holds_all_contexts(spark):
    counts = Counter(w.encode() for w in (words(1, 500, 60) + " abra abracadabra " * 3).split())
    frame = spark.createDataFrame([(bytearray(w), n) for w, n in counts.items()], "word binary, n bigint")
    assert ppm.build_trie(frame, 0.0) == _followers(counts)


@pytest.mark.parametrize("share", [0.0, 0.01])
def test_code_lengths_are_probabilities(share):
    followers = _followers(Counter({b"abra": 5, b"abba": 2, b"cab": 9}))
    total = sum(followers[b""].values())
    kept = {c: {b: n for b, n in f.items() if n >= share * total} for c, f in followers.items()}
    trie = ppm.Trie({c: f for c, f in kept.items() if f})
    for context in (b"", b" ", b" a", b" ab", b"abr", b"abra", b"zz", b" cab"):
        assert sum(10 ** trie[context + bytes([b])] for b in range(256)) == pytest.approx(1.0)


def test_trained_text_is_likelier_than_noise(spark):
    docs = documents(spark, ["the cat sat on the mat " * 5] * 30 + ["qzx vvk jjq " * 10, "the mat sat " * 10])
    rows = {r.doc_id: r for r in ppm.score_texts(docs, F.col("doc_id") < 30).collect()}
    assert rows[31].score > rows[30].score and rows[30].n_known == 1


def test_scores_on_odd_rows(spark):
    docs = clashing(odd_documents(spark), "row", "word", "n", "base", "training")
    rows = ppm.score_texts(docs, F.lit(True)).collect()
    assert len(rows) == docs.count() and all(r.score < 0 for r in rows)
    unseen = ppm.score_texts(docs, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in unseen)
    assert ppm.score_texts(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


def _plain_ppm(texts, training):
    """Scores by the model in memory, with every context that the training texts hold."""
    pieces = [ppm._pieces((t or "").encode().lower().split()) for t in texts]
    followers: dict[bytes, Counter] = {}
    for own, used in zip(pieces, training, strict=True):
        for piece in own if used else ():
            path = ppm.END * ppm.ORDER + piece
            for i in range(ppm.ORDER, len(path)):
                for order in range(ppm.ORDER + 1):
                    followers.setdefault(path[i - order : i], Counter())[path[i]] += 1
    trie = ppm.Trie({c: dict(f) for c, f in followers.items()})
    paths = [[ppm.END * ppm.ORDER + piece for piece in own] for own in pieces]
    return [sum(trie[p[i - ppm.ORDER : i + 1]] for p in own for i in range(ppm.ORDER, len(p))) for own in paths]


@pytest.mark.parametrize("head", [0, 40, 1 << 20])
def test_scores_use_every_counted_context(spark, monkeypatch, head):
    monkeypatch.setattr(ppm, "HEAD_GRAMS", head)
    # One very common word, so that all other entries are far below 2^-18 of the bytes.
    texts = ["common " * 60_000] + [words(i, 12 + i, 300) for i in range(30)] + ["", None, "Éé zq zz", "w1 q"]
    training = [i % 5 != 1 for i in range(len(texts))]
    docs = documents(spark, texts)
    rows = sorted(ppm.score_texts(docs, F.col("doc_id") % 5 != 1).collect(), key=lambda r: r.doc_id)
    assert [r.score for r in rows] == pytest.approx(_plain_ppm(texts, training), rel=1e-9)


def test_the_order_of_words_counts(spark):
    docs = documents(spark, ["red fox ran over icy hill now " * 9] * 20 + ["red fox ran over icy hill now", "hill icy now over fox red ran"])
    rows = {r.doc_id: r for r in ppm.score_texts(docs, F.col("doc_id") < 20).collect()}
    assert rows[20].base_score == pytest.approx(rows[21].base_score) and rows[20].score > rows[21].score + 1


def test_one_word_over_and_over_is_found_whole(spark):
    same = documents(spark, ["again " * 300, "again " * 200, "start " + "again " * 1000 + "stop"])
    assert _found(passages.repeated_passages(same)) == {(0, 0, 300), (1, 0, 200), (2, 1, 1001)}


def test_places_of_one_row_use_up_no_reach(spark):
    paragraph, boilerplate = words(11, 60, 9000), words(12, 100, 9000)
    own = " ".join(f"{words(100 + i, 30, 9000)} {boilerplate}" for i in range(40))
    texts = [f"{paragraph} " * 200, f"{paragraph} " * 150, own, f"{words(90, 20, 9000)} {boilerplate}"]
    docs = documents(spark, texts)
    assert _found(passages.repeated_passages(docs)) == _plain_passages(texts)
    assert _found(passages.repeated_passages(docs.repartition(3))) == _plain_passages(texts)
