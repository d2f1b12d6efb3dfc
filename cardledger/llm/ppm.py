"""Language-model scoring by prediction by partial matching, beside a smoothed unigram score.

A text is its words, separated by white space, and one end.  Training counts, over the
bytes of all training texts, what byte follows the ``ORDER`` bytes before it; the counts of
shorter contexts are sums of these.  A byte is coded in the longest context known; a
context that lacks it is left by an escape (distinct bytes over bytes seen and distinct
ones, "method C"), and the bytes it holds are excluded in the shorter ones; at last all
remaining bytes are alike.  A text's code length is the sum over its bytes.

Every count is kept: entries and contexts are tables, and a byte in its context (a
"gram") meets them in joins, once for each distinct gram of the texts.  As a longer
context's bytes are all seen in the shorter one, what is excluded is a sum per context, and
the code length is an expression.  The most frequent grams, at most ``HEAD_GRAMS``, and the
2**16 most frequent words of at most 64 bytes also travel to every task, but only to spare
their rows the join: results do not depend on it.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import stored, text_batches

ORDER = 4
#: What ends a text; no word holds it, so it also stands for what is before a text.
END = b"\n"
#: Code lengths that travel to every task, as a cache.
HEAD_GRAMS = 1 << 20
HEAD_WORDS = 1 << 16
HEAD_BYTES = 64


class Trie(dict):
    """The model in memory: log10 of the probability of a byte after a context, worked out when first asked for.

    Tests hold ``gram_costs`` against it.  A key is up to ``ORDER`` bytes of context followed by the byte.
    """

    def __init__(self, followers: dict[bytes, dict[int, int]]):
        super().__init__()
        self.followers = followers

    def __missing__(self, key: bytes) -> float:
        context, byte = key[:-1], key[-1]
        excluded: set[int] = set()
        found = 0.0
        while True:
            counts = {b: n for b, n in self.followers.get(context, {}).items() if b not in excluded}
            if counts:
                whole = sum(counts.values()) + len(counts)
                if byte in counts:
                    found += math.log10(counts[byte] / whole)
                    break
                if len(excluded) + len(counts) < 256:
                    found += math.log10(len(counts) / whole)
                excluded.update(counts)
            if not context:
                found -= math.log10(256 - len(excluded))
                break
            context = context[1:]
        self[key] = found
        return found


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts of ``docs`` (text): A-Z lower-cased, cut at white space."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def rows():
            for part in batched(words.items(), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())],
                    names=["word", "n"],
                )
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update((text or b"").lower().split())
                if len(words) > 300_000:
                    yield from rows()
        yield from rows()

    return (
        docs.select(F.col("text").cast("binary").alias("text"))
        .mapInArrow(count, "word binary, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def context_counts(words: DataFrame) -> DataFrame:
    """(entry, n): how often a byte follows a context; entry is the context's bytes, then the byte, as a number.

    The number's top byte is the length of the context.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[bytes, int]] = []
        size = 0
        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            waiting += pairs
            size += sum(len(w) for w, _ in pairs)
            if size > 1_000_000:
                yield from _entries(waiting)
                waiting, size = [], 0
        yield from _entries(waiting)

    return words.select("word", "n").mapInArrow(count, "entry bigint, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))


def _entries(pairs: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    if not pairs:
        return
    codes = np.frombuffer(b" " + b" ".join(w for w, _ in pairs) + b" ", dtype=np.uint8)
    lengths = np.array([len(w) for w, _ in pairs])
    # Word i's bytes and the blank after it are coded; the blank before it is its first context.
    coded = lengths + 1
    starts = np.cumsum(coded) - coded + 1
    at = np.repeat(starts, coded) + np.arange(coded.sum()) - np.repeat(np.cumsum(coded) - coded, coded)
    history = at - np.repeat(starts, coded) + 1
    weight = np.repeat(np.array([n for _, n in pairs], dtype=np.float64), coded)
    for order in range(ORDER + 1):
        use = history >= order
        entry = np.zeros(int(use.sum()), dtype=np.int64)
        for back in range(order, -1, -1):
            entry = entry << 8 | codes[at[use] - back]
        entry |= order << 56
        found, where = np.unique(entry, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(np.bincount(where, weights=weight[use]).astype(np.int64))], names=["entry", "n"]
        )


def build_trie(words: DataFrame, entry_share: float = 0.0) -> dict[bytes, dict[int, int]]:
    """context -> byte -> count, of the entries that hold at least ``entry_share`` of the bytes coded."""
    total = words.agg(F.sum(F.col("n") * (F.length("word") + 1))).first()[0] or 0
    entries = context_counts(words).filter(F.col("n") >= F.lit(float(total) * entry_share)).toArrow()
    followers: dict[bytes, dict[int, int]] = {}
    for entry, n in zip(entries["entry"].to_pylist(), entries["n"].to_pylist(), strict=True):
        order = entry >> 56
        path = (entry & ((1 << 56) - 1)).to_bytes(order + 1, "big")
        followers.setdefault(path[:-1], {})[path[-1]] = n
    return followers


def _pieces(words: list[bytes]) -> list[bytes]:
    """What is coded of a text: all its words in one byte string, so that contexts reach across blanks, and its end."""
    return [b" ".join(words) + END]


def _grams(pieces: list[bytes]) -> np.ndarray:
    """For every byte of ``pieces``: the ``ORDER`` bytes before it, then the byte, as a number; none is before a piece."""
    codes = np.frombuffer(b"".join(END * ORDER + piece for piece in pieces), dtype=np.uint8)
    gram = np.zeros(len(codes) - ORDER, dtype=np.int64)
    for back in range(ORDER, -1, -1):
        gram = gram << 8 | codes[ORDER - back : len(codes) - back]
    ends = np.cumsum([len(piece) + ORDER for piece in pieces[:-1]], dtype=np.int64)
    coded = np.ones(len(gram), dtype=bool)
    coded[(ends[:, None] - np.arange(1, ORDER + 1)).ravel()] = False
    return gram[coded]


def _kinds(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct numbers, which of them each one is)."""
    encoded = pa.array(gram).dictionary_encode()
    return encoded.dictionary.to_numpy(), encoded.indices.to_numpy()


def gram_counts(docs: DataFrame) -> DataFrame:
    """(entry, n): how often a byte follows the ``ORDER`` bytes before it in the texts of ``docs`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_batches(batch.column(0)):
                kinds, which = _kinds(_grams([piece for text in texts for piece in _pieces(text.lower().split())]))
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.bincount(which))], names=["entry", "n"])

    return (
        docs.select(F.col("text").cast("binary").alias("text"))
        .mapInArrow(count, "entry bigint, n bigint")
        .groupBy("entry")
        .agg(F.sum("n").alias("n"))
    )


def _ending(entry: Column, order: int) -> Column:
    """An entry's last ``order`` bytes of context and its byte."""
    return entry.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


def model_tables(grams: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """By order, (entry, n) and (context, t, d, x): bytes seen, distinct ones, and how often these are in the shorter context."""
    entries = [grams]
    for order in range(ORDER - 1, -1, -1):
        shorter = entries[0].groupBy(_ending(F.col("entry"), order).alias("entry")).agg(F.sum("n").alias("n"))
        entries.insert(0, stored(shorter, f"entries-{order}"))
    contexts = []
    for order, held in enumerate(entries):
        under = F.lit(0).cast("long")
        if order:
            held = held.withColumn("ending", _ending(F.col("entry"), order - 1))
            held = held.join(entries[order - 1].select(F.col("entry").alias("ending"), F.col("n").alias("under")), "ending")
            under = F.col("under")
        whole = held.groupBy(F.shiftright("entry", 8).alias("context")).agg(
            F.sum("n").alias("t"), F.count("*").alias("d"), F.sum(under).alias("x")
        )
        contexts.append(stored(whole, f"contexts-{order}"))
    return entries, contexts


def gram_costs(grams: DataFrame, entries: list[DataFrame], contexts: list[DataFrame]) -> DataFrame:
    """(gram, cost) for distinct grams: log10 of the probability of the byte after its context."""
    met = grams
    for order in range(ORDER + 1):
        part = _ending(F.col("gram"), order)
        names = [F.col(c).alias(f"{c}{order}") for c in ("t", "d", "x")]
        met = met.withColumn("key", part).join(entries[order].select(F.col("entry").alias("key"), F.col("n").alias(f"n{order}")), "key", "left")
        met = met.withColumn("key", F.shiftright(part, 8)).join(contexts[order].select(F.col("context").alias("key"), *names), "key", "left")
        met = met.drop("key")
    cost, escapes = None, F.lit(0.0)
    nothing = F.lit(0).cast("long")
    for order in range(ORDER, -1, -1):
        longer = order + 1 if order < ORDER else None
        taken = F.coalesce(f"d{longer}", nothing) if longer else nothing
        gone = F.coalesce(f"x{longer}", nothing) if longer else nothing
        fresh = F.col(f"d{order}") - taken
        whole = F.col(f"t{order}") - gone + fresh
        here = (F.col(f"n{order}").isNotNull(), escapes + F.log10(F.col(f"n{order}") / whole))
        cost = F.when(*here) if cost is None else cost.when(*here)
        escapes = escapes + F.when(fresh > 0, F.log10(fresh / whole)).otherwise(0.0)
    # Only a byte in no context at all gets here, so there are at most 255 distinct ones.
    return met.select("gram", cost.otherwise(escapes - F.log10(F.lit(256) - F.coalesce("d0", nothing))).alias("cost"))


def _frequent(grams: DataFrame, most: int) -> DataFrame:
    """The grams from a power of two of occurrences on, the least that leaves ``most`` or fewer."""
    sizes = grams.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    left, least = 0, None
    for power, number in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        left += number
        if left > most:
            break
        least = power
    # The logarithm may be off by a rounding, the same way in both places.
    return grams.filter(F.floor(F.log2("n")) >= least) if least is not None else grams.limit(0)


def score_texts(docs: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``training`` holds.  ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over words and end.  A null or empty text is its end
    alone.  Rows are scored one by one, so repeated rows and null ids have their own result;
    without any training row every word is unknown.
    """
    spark = docs.sparkSession
    text = F.col(text_column).cast("string").cast("binary").alias("text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"), text, training.alias("training")
    )
    words = stored(word_counts(rows.filter("training")), "words")
    ends = rows.filter("training").count()
    whole = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = (whole.n or 0) + ends, whole.v + (1 if ends else 0)
    entries, contexts = model_tables(stored(gram_counts(rows.filter("training")), "grams"))
    head = (
        words.filter(F.length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(HEAD_WORDS).select("word", "n").toArrow()
    )
    counts = dict(zip(head["word"].to_pylist(), head["n"].to_pylist(), strict=True))
    # All of these are entries of the longest contexts, so that the escapes take no part.
    usual = (
        _frequent(entries[ORDER], HEAD_GRAMS)
        .withColumn("context", F.shiftright("entry", 8))
        .join(contexts[ORDER], "context")
        .select("entry", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("cost"))
        .toArrow()
        .sort_by("entry")
    )
    model = spark.sparkContext.broadcast((counts, usual["entry"].to_numpy(), usual["cost"].to_numpy()))
    end_base, end_known = math.log10(ends + 0.5), int(ends > 0)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, known_grams, known_costs = model.value
        base = {w: math.log10(n + 0.5) for w, n in common.items()}
        for batch in batches:
            for start, texts in text_batches(batch.column(2), 1_000_000):
                part = batch.slice(start, len(texts))
                # One row for each text, under a key that is no word, then one for each rarer word and gram.
                key, row = [], part.column(0).to_pylist()
                n_tokens, n_known, base_sum = [], [], []
                pieces, sizes = [], []
                others = []
                for number, text in zip(row, texts, strict=True):
                    words = text.lower().split()
                    known, unigram = end_known, end_base
                    for word, n in Counter(words).items():
                        own = base.get(word)
                        if own is None:
                            others.append((word, number, n))
                        else:
                            known += n
                            unigram += n * own
                    key.append(b" " + struct.pack(">q", number))
                    n_tokens.append(len(words) + 1)
                    n_known.append(known)
                    base_sum.append(unigram)
                    coded = _pieces(words)
                    pieces += coded
                    sizes.append(sum(map(len, coded)))
                kinds, which = _kinds(_grams(pieces))
                at = np.minimum(np.searchsorted(known_grams, kinds), max(len(known_grams) - 1, 0))
                met = known_grams[at] == kinds if len(known_grams) else np.zeros(len(kinds), dtype=bool)
                costs = np.where(met, known_costs[at], 0.0) if len(known_grams) else np.zeros(len(kinds))
                begins = np.cumsum(sizes) - sizes
                scores = np.add.reduceat(costs[which], begins)
                rare = np.flatnonzero(~met[which])
                owner = np.searchsorted(begins, rare, side="right") - 1
                pairs, times = np.unique(owner * len(kinds) + which[rare], return_counts=True)
                g, m, k = len(pairs), len(others), len(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key + [w for w, _, _ in others] + [None] * g, pa.binary()),
                        pa.concat_arrays([pa.nulls(k + m, pa.int64()), pa.array(kinds[pairs % len(kinds)])]),
                        pa.array(row + [r for _, r, _ in others] + [row[i] for i in (pairs // len(kinds)).tolist()], pa.int64()),
                        pa.concat_arrays([part.column(1), pa.nulls(m + g, part.column(1).type)]),
                        pa.array([0] * k + [n for _, _, n in others] + times.tolist(), pa.int64()),
                        pa.array(n_tokens + [0] * (m + g), pa.int64()),
                        pa.array(n_known + [0] * (m + g), pa.int64()),
                        pa.array(base_sum + [0.0] * (m + g), pa.float64()),
                        pa.array(np.concatenate([scores, np.zeros(m + g)])),
                    ],
                    names=["word", "gram", "row", "doc_id", "times", "n_tokens", "n_known", "base", "score"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    scanned = rows.select("row", "doc_id", "text").mapInArrow(
        scan,
        f"word binary, gram bigint, row bigint, doc_id {kind}, times bigint, n_tokens bigint, n_known bigint, base double, score double",
    )
    scanned = stored(scanned, "scanned-texts")
    seen = F.coalesce("n", F.lit(0))
    met = (
        scanned.filter("gram IS NULL")
        .join(words, "word", "left")
        .withColumn("n_known", F.col("n_known") + F.when(seen > 0, F.col("times")).otherwise(0))
        .withColumn("base", F.col("base") + F.col("times") * F.log10(seen + 0.5))
    )
    rare = scanned.filter("gram IS NOT NULL").select("gram", "row", "times")
    costs = stored(gram_costs(rare.select("gram").distinct(), entries, contexts), "gram-costs")
    coded = rare.join(costs, "gram").select("row", (F.col("times") * F.col("cost")).alias("score"))
    columns = ["row", "doc_id", "n_tokens", "n_known", "base", "score"]
    return (
        met.select(*columns)
        .unionByName(coded, allowMissingColumns=True)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base"),
            F.sum("score").alias("score"),
        )
        .select(
            "doc_id",
            "n_tokens",
            "n_known",
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * F.lit(math.log10(tokens + 0.5 * (kinds + 1)))).alias("base_score"),
            "score",
        )
    )
