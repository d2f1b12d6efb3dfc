"""Toxicity: maximum-scoring segments over token log-odds.

Fitting: for every unit (a word, or the first 4, 5 or 6 bytes of one) the documents of
either label that hold it are counted, and its log-odds between the labels are taken
under an informative Dirichlet prior, whose pseudo-counts follow the unit's overall
rate.  Units whose log-odds are large and stand ``MIN_Z`` standard deviations above zero
form the lexicon; so do those whose toxic documents are more than chance gives any unit, by
a one-sided test, as the standard deviation of a word that no clean document uses is large.  Scanning: a word scores the log-odds of its longest unit in the lexicon,
every other word a small negative number, and one linear pass finds all maximal
segments.  Calibration: the best of n words' segments follows an extreme-value law,
p = 1 - exp(-K n exp(-lambda S)), whose lambda and K come from clean documents; the
document's score is that law's distribution function moved to the cut between the
labels.

The lexicon comes from at most ``TRAINING_ROWS`` labelled rows and holds every unit that passes
the tests, so it grows with those rows and not with the corpus, and can travel to every task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.llm.common import WORD_BYTES, fold_of, free_name, stored

#: Labelled rows that the lexicon is fitted on, drawn by a hash of the id.
TRAINING_ROWS = 40_000
#: Weight of the Dirichlet prior in documents.
PRIOR = 100.0
MIN_Z = 4.0
#: Least log-odds of a unit: common words that toxic texts merely hold a little more often stay out.
MIN_LOG_ODDS = 1.5
#: Score of a word outside the lexicon.
DRIFT = -0.25
#: Passages with a smaller chance in clean text are reported.
SIGNIFICANT = 0.01
PREFIXES = (4, 5, 6)

PASSAGE = "struct<first_word:bigint,last_word:bigint,score:double,p_value:double>"
RESULT = f"score double, n_words bigint, passages array<{PASSAGE}>"


@dataclass
class ToxicityModel:
    lexicon: dict[bytes, float]
    decay: float  # lambda of the extreme-value law
    size: float  # K of the extreme-value law
    centre: float  # standardised segment score at which the labels part
    base: float  # score of a document without any passage


class UnitScores(dict):
    """Word -> log-odds of its longest unit in the lexicon, else the drift; filled as words come."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> float:
        found = self.lexicon.get(word)
        for n in reversed(PREFIXES):
            if found is None and len(word) > n:
                found = self.lexicon.get(word[:n] + b"*")
        found = DRIFT if found is None else found
        if len(self) > 400_000:
            self.clear()
        self[word] = found
        return found


def units_of(words: set[bytes]) -> set[bytes]:
    found = set(words)
    for n in PREFIXES:
        found.update(w[:n] + b"*" for w in words if len(w) > n)
    return found


def maximal_segments(positions: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal segments (first, last, score) of a word sequence, in linear time.

    Given are the positions and scores of the positive words; every other word scores
    ``drift``.  A segment is maximal when no segment around or inside it scores more.
    """
    # Of every candidate: first, last, sum before, sum up to its end, and the nearest earlier one that starts lower.
    stack: list[tuple[int, int, float, float, int]] = []
    total, previous = 0.0, -1
    for at, score in zip(positions, scores, strict=True):
        total += (at - previous - 1) * drift
        previous = at
        first, before = at, total
        total += score
        # Candidates passed over by their links are never looked at again: the next one links past them.
        link = len(stack) - 1
        while link >= 0 and stack[link][2] >= before:
            link = stack[link][4]
        # If that candidate also ends lower the two join, and the joined one has its link already.
        while link >= 0 and stack[link][3] < total:
            first, _, before, _, beyond = stack[link]
            del stack[link:]
            link = beyond
        stack.append((first, at, before, total, link))
    return [(first, last, after - before) for first, last, before, after, _ in stack]


def _segments(text: bytes | None, scores: UnitScores) -> tuple[int, list[tuple[int, int, float]]]:
    words = (text or b"").translate(WORD_BYTES).split()
    values = np.fromiter(map(scores.__getitem__, words), dtype=np.float64, count=len(words))
    positive = np.flatnonzero(values > 0)
    return len(words), maximal_segments(positive.tolist(), values[positive].tolist())


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training_rows: int = TRAINING_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ToxicityModel:
    """A model from the labelled documents outside fold 0, at most ``training_rows`` of them.

    Rows without a label or id are not learned from.  Without any labelled row of one
    kind the lexicon is empty and every text scores the share of toxic labels.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
        .filter("labelled IS NOT NULL AND toxic IN (0, 1)")
        .filter(fold_of(F.col("labelled")) != 0)
        .orderBy(F.xxhash64("labelled"), "labelled", "toxic")
        .limit(training_rows)
    )
    training = stored(
        docs.select(F.col(id_column).alias("labelled"), F.col(text_column).cast("binary").alias("text"))
        .join(F.broadcast(chosen), "labelled")  # at most training_rows of two numbers
        .select("text", "toxic"),
        "toxicity-training",
    )

    def count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (Counter(), Counter())
        documents = [0, 0]

        def rows():
            for toxic in (0, 1):
                counts = kinds[toxic]
                counts[b""] += documents[toxic]
                documents[toxic] = 0
                for part in batched(counts.items(), 100_000):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "unit": pa.array([u for u, _ in part], pa.binary()),
                            "toxic": pa.array([toxic] * len(part), pa.int32()),
                            "documents": pa.array([n for _, n in part], pa.int64()),
                        }
                    )
                counts.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                documents[toxic] += 1
                kinds[toxic].update(units_of(set((text or b"").translate(WORD_BYTES).split())))
            if len(kinds[0]) + len(kinds[1]) > 400_000:
                yield from rows()
        yield from rows()

    counts = (
        training.mapInArrow(count_units, "unit binary, toxic int, documents bigint")
        .groupBy("unit")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("documents")).otherwise(0)).alias("t"),
            F.sum(F.when(F.col("toxic") == 0, F.col("documents")).otherwise(0)).alias("c"),
        )
    )
    counts = stored(counts, "toxicity-units")
    whole = counts.filter(F.col("unit") == F.lit(b"")).select("t", "c").first()
    toxic, clean = (int(whole.t), int(whole.c)) if whole else (0, 0)
    share = (toxic + 0.5) / (toxic + clean + 1)
    if not toxic or not clean:
        return ToxicityModel({}, 1.0, 1.0, 0.0, min(share, 1 - 1e-9))
    prior = F.lit(PRIOR) * (F.col("t") + F.col("c")) / F.lit(float(toxic + clean))

    def odds(count: str, size: int):
        seen = F.col(count) + prior
        return F.log(seen / (F.lit(size + PRIOR) - seen))

    log_odds = odds("t", toxic) - odds("c", clean)
    error = F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior))
    # Chance that t of t + c documents are toxic is at most exp(-surprise): Chernoff's bound for t above its share.
    rate = F.lit(toxic / (toxic + clean))
    used = F.col("t") + F.col("c")
    surprise = F.col("t") * F.log(F.col("t") / (used * rate)) + F.when(
        F.col("c") > 0, F.col("c") * F.log(F.col("c") / (used * (1 - rate)))
    ).otherwise(0.0)
    surprise = F.when(F.col("t") > used * rate, F.greatest(surprise, F.lit(0.0))).otherwise(0.0)
    # Less than one unit of all is expected beyond this by chance.
    least = math.log(max(counts.count(), 2))
    lexicon_rows = (
        counts.filter("length(unit) > 0 AND t > 0")
        .select("unit", log_odds.alias("log_odds"), (log_odds / error).alias("z"), surprise.alias("surprise"))
        .filter(((F.col("z") >= MIN_Z) | (F.col("surprise") > least)) & (F.col("log_odds") >= MIN_LOG_ODDS))
        .select("unit", "log_odds")
        .collect()
    )
    lexicon = {bytes(r.unit): float(r.log_odds) for r in lexicon_rows}

    def best_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = UnitScores(lexicon)
        for batch in batches:
            words, best, hits, mass = [], [], [], []
            for text in batch.column(0).to_pylist():
                n, segments = _segments(text, scores)
                words.append(n)
                best.append(max((s for _, _, s in segments), default=0.0))
                hits.append(len(segments))
                mass.append(sum(s for _, _, s in segments))
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column(1).cast(pa.int32()),
                    "words": pa.array(words, pa.int64()),
                    "best": pa.array(best, pa.float64()),
                    "hits": pa.array(hits, pa.int64()),
                    "mass": pa.array(mass, pa.float64()),
                }
            )

    found = stored(
        training.mapInArrow(best_segments, "toxic int, words bigint, best double, hits bigint, mass double"),
        "toxicity-segments",
    )
    sums = {
        (r.toxic, r.some): r
        for r in found.groupBy("toxic", (F.col("best") > 0).alias("some"))
        .agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.sum("hits").alias("hits"))
        .collect()
    }
    bare = {k: int(sums[k, False].n) if (k, False) in sums else 0 for k in (0, 1)}
    clean_words = sum(int(r.words) for (k, _), r in sums.items() if k == 0)
    clean_hits = sum(int(r.hits) for (k, _), r in sums.items() if k == 0)
    unit = float(np.median(list(lexicon.values()))) if lexicon else 1.0
    decay = _decay((clean_hits + 0.5) / (clean_words + 1), unit)
    hit_docs = int(sums[0, True].n) if (0, True) in sums else 0
    reached = (hit_docs + 0.5) / (clean + 1)
    size = -math.log1p(-reached) / (max(clean_words / clean, 1.0) * math.exp(-decay * unit))
    # Where the labels part: the standardised score that classes most training documents right.
    z = F.col("best") * decay - F.log(F.greatest("words", F.lit(1)) * F.lit(size))
    bins = found.filter("best > 0").groupBy(F.round(z, 1).alias("z"), "toxic").count().collect()
    centre = _cut([(float(r.z), int(r.toxic), int(r["count"])) for r in bins])
    base = min((bare[1] + 0.5) / (bare[0] + bare[1] + 1), 0.49)
    return ToxicityModel(lexicon, decay, size, centre, base)


def _decay(rate: float, unit: float, drift: float = DRIFT) -> float:
    """The positive root of rate exp(x unit) + (1 - rate) exp(x drift) = 1."""
    low, high = 0.0, 1.0
    value = lambda x: rate * math.exp(x * unit) + (1 - rate) * math.exp(x * drift) - 1
    if rate * unit + (1 - rate) * drift >= 0:
        return 1e-3
    while value(high) < 0 and high < 600 / max(unit, 1):
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def _cut(bins: list[tuple[float, int, int]]) -> float:
    best, at = 0, -math.inf
    right = sum(n for _, toxic, n in bins if toxic)
    best, at = right, min((z for z, _, _ in bins), default=0.0) - 0.05
    for z in sorted({z for z, _, _ in bins}):
        right += sum(n if not toxic else -n for x, toxic, n in bins if x == z)
        if right > best:
            best, at = right, z + 0.05
    return at


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (score, n_words, passages); nothing else of a row is read.

    ``passages`` lists every maximal segment whose chance in clean text of this length is
    under ``SIGNIFICANT``, by word numbers from 0.  Null and empty texts have no passage
    and score like any text without one.  ``toxicity`` gets underscores where taken.
    """
    name = free_name(docs, "toxicity")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(RESULT))])
    at = docs.columns.index(text_column)
    kind = pa.struct(
        [
            ("score", pa.float64()),
            ("n_words", pa.int64()),
            (
                "passages",
                pa.list_(
                    pa.struct(
                        [("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("p_value", pa.float64())]
                    )
                ),
            ),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = UnitScores(model.lexicon)
        for batch in batches:
            found = []
            for text in batch.column(at).cast(pa.binary()).to_pylist():
                n, segments = _segments(text, scores)
                rows, best = [], 0.0
                for first, last, score in segments:
                    best = max(best, score)
                    p = -math.expm1(-model.size * max(n, 1) * math.exp(-model.decay * score))
                    if p < SIGNIFICANT:
                        rows.append({"first_word": first, "last_word": last, "score": score, "p_value": p})
                total = model.base
                if best > 0:
                    z = best * model.decay - math.log(max(n, 1) * model.size)
                    # 0.5 at the centre: exp(-exp(-x)) is 0.5 at x = -log(log 2)
                    total = math.exp(-math.exp(min(700.0, model.centre - z + math.log(math.log(2)))))
                    total = max(total, model.base)
                found.append({"score": total, "n_words": n, "passages": rows})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name])

    return docs.mapInArrow(scan, schema)
