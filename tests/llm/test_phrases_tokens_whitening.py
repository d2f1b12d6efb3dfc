"""op11 to op13 against plain versions."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardledger.llm import alignment, contamination, whitening
from tests.llm.helpers import SCHEMA, clashing, documents, odd_documents, plain_words, words

public_tokenizers = pytest.importorskip("public_tokenizers")
ITEMS = "item_id bigint, text string"


# ---- op11 -----------------------------------------------------------------------


def _plain_leaks(texts, items, n=10):
    """(n_words, n_hit, items) per text, and which items have a proximity match."""
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(len(w) - n, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    every = [plain_words(t) for t in texts]
    counts = Counter(w for ws in every for w in ws)
    found = []
    for w in every:
        hit, held, near = set(), set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    held |= ids
            rarest = min(range(len(window)), key=lambda j: (counts[window[j]], j))
            for i, word in enumerate(w):
                around = set(w[max(i - contamination.REACH, 0) : i + contamination.REACH + 1])
                if word == window[rarest] and set(window) <= around:
                    near |= ids
        found.append((len(w), len(hit), sorted(held), sorted(near)))
    return found


def _leaks(spark, docs, items, **more):
    found = contamination.find_leaks(docs, spark.createDataFrame(items, ITEMS), **more)
    return {r.doc_id: r.leak for r in found.collect()}


def test_phrases_against_a_plain_search(spark):
    items = [(i, words(500 + i, 7 + 5 * i, 60)) for i in range(9)]
    items += [(20, "w1"), (21, "w2 w3"), (22, "is " * 14), (23, "is " * 30), (24, ""), (25, None), (None, words(1, 12)), (3, words(7, 15))]
    long = words(500 + 8, 47, 60).split()
    texts = [words(i, 40 + i, 60) for i in range(30)]
    texts += [" ".join(long[3:20]), " ".join([*long[:12], "x", *long[12:25]]), " ".join(long[i] for i in (5, 4, 6, 8, 7, 9, 10, 12, 11, 13))]
    texts += ["IS, is! " * 9, "is", "", None, f"{words(2, 9)} {items[5][1].upper()} {words(3, 9)} {items[6][1]}", words(1, 12), "w2-W3"]
    found = _leaks(spark, documents(spark, texts), items)
    for i, (n, hit, held, near) in enumerate(_plain_leaks(texts, items)):
        leak = found[i]
        assert (leak.n_words, leak.n_hit, leak.items, leak.n_items) == (n, hit, held, len(held)), i
        assert (leak.near_items, leak.n_near, leak.contaminated) == (near, len(near), hit > 0), i
        assert leak.items_sha256 == hashlib.sha256(",".join(held).encode()).hexdigest()
    assert found[30].n_hit == 17 and found[32].n_hit == 0 and found[32].n_near > 0


def test_phrases_of_odd_rows_and_clashing_names(spark):
    docs = clashing(odd_documents(spark), "leak", "row", "term", "place", "words", "kept", "head", "n_words", "window_id", "item")
    items = spark.createDataFrame([(1, "single line of words"), (2, words(1, 60_000).split(" ", 40)[40][:200])], ITEMS)
    found = contamination.find_leaks(docs, clashing(items, "word", "window", "doc_id"))
    assert found.columns == [*docs.columns, "leak_"] and found.count() == docs.count()
    rows = found.collect()
    assert sum(r.leak_.n_hit == 4 for r in rows) == 3 and all(r.leak == "mine" for r in rows)
    assert next(r for r in rows if r.doc_id == 6).leak_.contaminated
    nothing = spark.createDataFrame([], SCHEMA)
    assert contamination.find_leaks(nothing, items).count() == 0
    none = contamination.find_leaks(odd_documents(spark), items.limit(0)).collect()
    assert len(none) == 10 and not any(r.leak.contaminated or r.leak.n_near for r in none)
    assert all(r.leak.n_near is None for r in contamination.find_leaks(odd_documents(spark), items, reach=None).collect())


def test_index_of_all_words(spark):
    index = contamination.positional_index(documents(spark, ["A b a", "", None]), keep=("doc_id",)).collect()
    assert {(r.place, r.term) for r in index if r.place is not None} == {(0, "a"), (1, "b"), (2, "a")}
    assert sorted((r.kept.doc_id, r.n_words) for r in index if r.head) == [(0, 3), (1, 0), (2, 0)]


# ---- op12 -----------------------------------------------------------------------


def _plain_alignment(texts):
    """Every document's digest columns, by all pairs of tokens, with the tokenizers of the contract."""
    import sentencepiece

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [c for r in ((33, 126), (161, 172), (174, 255)) for c in range(r[0], r[1] + 1)]
    shown = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}

    def bytes_a(i):
        return bytes(shown[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    held, counts = [], Counter()
    for text in texts:
        empty = (0, 0, 0, "", [])
        if not text:
            held.append(empty)
            continue
        sides = []
        for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a), (b.encode(text), bytes_b)):
            at, spans = 0, []
            for i in ids:
                spans.append((at, at + len(spell(i)), i))
                at = spans[-1][1]
            sides.append((spans, b"".join(map(spell, ids))))
        (spans_a, whole_a), (spans_b, whole_b) = sides
        if not whole_a == whole_b == (" " + text).encode():
            held.append(empty)
            continue
        ends = sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b})
        groups = [
            "|".join(",".join(str(i) for _, e, i in spans if low < e <= high) for spans in (spans_a, spans_b))
            for low, high in zip([0, *ends], ends, strict=False)
        ]
        links = [(i, j) for s, e, i in spans_a for t, f, j in spans_b if max(s, t) < min(e, f)]
        counts.update(set(links))
        held.append((len(spans_a), len(spans_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    best = Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [
        (n_a, n_b, g, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), digest)
        for n_a, n_b, g, digest, links in held
    ], counts


TEXTS = [
    *(words(i, 20, 90) for i in range(8)),
    "Übergrößenträger straßenweise, naïveté ☃ 世界 🎉",
    "a <|endoftext|> b <s> </s> <unk> <0x41>",
    "aaaa aaaaa aaa  aa\n\n\taaaaaaaaa",
    "▁ lower block",
    "nul \x00 and \x07 bell",
    "",
    None,
    " leading", "trailing  ", "x" * 3000,
]


@pytest.mark.parametrize("cached", [0, 7, 1 << 19])
def test_alignment_against_all_pairs_of_tokens(spark, cached):
    documents_, pairs = alignment.align_tokenizers(documents(spark, TEXTS), cached_pairs=cached)
    expected, counts = _plain_alignment(TEXTS)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = {r.doc_id: tuple(r[n] for n in names) for r in documents_.collect()}
    assert [found[i] for i in range(len(TEXTS))] == expected
    assert {(r.a, r.b): r.documents for r in pairs.collect()} == dict(counts)


def test_alignment_of_odd_rows(spark):
    docs = clashing(odd_documents(spark), "row", "same", "pairs", "n_a")
    found, _ = alignment.align_tokenizers(docs)
    assert found.count() == 10
    assert found.filter("n_a = 0 AND groups_sha256 = '' AND count_sum = 0").count() == 3
    empty, pairs = alignment.align_tokenizers(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and pairs.count() == 0


def test_a_long_document_is_spelled_in_parts(monkeypatch):
    aligner = alignment.Aligner(*alignment.default_paths())
    texts = [t.encode() for t in (words(1, 300), "short", words(2, 500), words(3, 40))]
    whole = aligner.align(texts)["groups_sha256"]
    monkeypatch.setattr(alignment, "SPELLED_TOKENS", 37)
    assert aligner.align(texts)["groups_sha256"] == whole


# ---- op13 -----------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>"


def _integers(rows):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good], dtype=object)
    return [i for i, _ in good], x


def test_whitening_against_a_plain_eigenproblem(spark):
    chance = np.random.default_rng(5)
    turn = np.linalg.qr(chance.normal(size=(12, 12)))[0]
    values = (chance.normal(size=(400, 12)) * np.linspace(1, 3, 12)) @ turn * 0.2 + 0.7
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
    rows += [(900, None), (901, [float("nan")] * 12), (902, [1.0] * 11 + [None]), (903, [float("inf")] * 12), rows[0], (None, rows[1][1])]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    ids, x = _integers(rows)
    n, s = len(ids), x.sum(axis=0)
    deviations = {i: int(((n * v - s) ** 2).sum()) for i, v in zip(ids, x, strict=True)}
    centred = (x * n - s).astype(float) / n
    e, basis = np.linalg.eigh(centred.T @ centred / n)
    e, basis = e[::-1], basis[:, ::-1]
    plain = centred @ basis[:, :8] / np.sqrt(e[:8])
    assert len(found) == n * 8
    for k in range(8):
        own = [r for r in found if r.component == k + 1]
        assert all(r.n == n and r.deviation == deviations[r.vec_id] for r in own)
        assert abs(own[0].explained - e[k] / e.sum()) < 1e-12 and own[0].identity_error < 1e-9
        first = next(r for r in own if r.vec_id == 2).whitened
        sign = np.sign(first * plain[ids.index(2), k])
        assert max(abs(r.whitened - sign * plain[ids.index(r.vec_id), k]) for r in own) < 1e-9


def test_components_of_hard_matrices():
    chance = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 60):
        basis = np.linalg.qr(chance.normal(size=(n, n)))[0]
        for spectrum in (np.ones(n), np.zeros(n), np.arange(n) // 2 + 1.0, 10.0 ** -np.arange(n), np.r_[np.full(n - 1, 1e-9), 1.0]):
            a = basis * spectrum @ basis.T
            a = (a + a.T) / 2
            values, vectors = whitening.spectral_components(a)
            scale = max(np.abs(spectrum).max(), 1e-300)
            assert np.abs(values - np.sort(spectrum)[::-1]).max() < 1e-13 * scale * n
            assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13 * n
            assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * scale * n


def test_polar_factor_of_an_indefinite_matrix():
    a = np.random.default_rng(3).normal(size=(20, 20))
    a = a + a.T
    u = whitening.polar_factor(a)
    assert np.abs(u @ u - np.eye(20)).max() < 1e-12  # symmetric and orthogonal
    assert np.linalg.eigvalsh(u @ a).min() > 0


def test_whitening_of_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>, deviation string, white string"
    frame = lambda rows: spark.createDataFrame([(*r, "mine", "mine") for r in rows], schema)
    assert whitening.whiten(frame([])).count() == 0
    assert whitening.whiten(frame([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    flat = whitening.whiten(frame([(1, [1.0, 5.0]), (2, [3.0, 5.0]), (3, [4.0, 5.0]), (4, [1.0])])).collect()
    assert {(r.vec_id, r.component) for r in flat} == {(1, 1), (2, 1), (3, 1)} and flat[0].explained == 1.0
    far = whitening.whiten(frame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 2.0])])).collect()
    assert all(r.deviation is None for r in far if r.component == 1) and all(np.isfinite(r.whitened) for r in far)
    wide = whitening.whiten(frame([(i, [200.0 * i, float(i % 3)]) for i in range(50)])).collect()
    assert all(r.deviation > 0 for r in wide) and wide[0].identity_error < 1e-4


def test_sums_of_whole_numbers_stay_exact():
    big = np.full((3, 2), 1 << 60, dtype=np.int64)
    assert whitening.exact_sum(iter([big, big, big])).tolist() == [[3 << 60] * 2] * 3
    assert whitening.scatter(big).tolist() == [[3 << 120] * 2] * 2
    assert whitening.column_sums(big).tolist() == [3 << 60] * 2
