"""Quality classifier: a sparse ensemble of rules over text statistics.

Every text gets some twenty statistics of its bytes, words and lines.  A random forest of
shallow trees is fitted on labelled rows; each path from a root to a node is a rule, a
conjunction of comparisons.  A logistic regression with an L1 penalty picks and weighs the
rules, and what has a weight is compiled into one Spark column expression, so scoring is
a projection.  Trees and weights come from Spark's own learners.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardledger.llm.common import WORD_BYTES, fold_of, free_name, stored

#: Labelled rows that trees and weights are fitted on, drawn by a hash of the id.
TRAINING_ROWS = 20_000
TREES = 20
DEPTH = 3
PENALTY = 0.001
SEED = 11

STATISTICS = [
    "bytes",
    "words",
    "mean_word",
    "long_words",
    "short_words",
    "distinct_words",
    "top_word",
    "repeated_next",
    "single_words",
    "symbols",
    "digits",
    "capitals",
    "blanks",
    "other_bytes",
    "stops",
    "bars",
    "marks",
    "symbol_runs",
    "lines",
    "line_words",
    "repeated_lines",
    "packed",
]

Condition = tuple[int, bool, float]  # statistic, whether at most the bound, bound


@dataclass
class RuleModel:
    rules: list[tuple[tuple[Condition, ...], float]]
    intercept: float


def _classes() -> np.ndarray:
    """Byte -> membership in digits, capitals, blanks, other bytes, stops, bars, marks, symbols."""
    table = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        table[b] = [
            c.isascii() and c.isdigit(),
            c.isascii() and c.isupper(),
            b in b" \t\n\x0b\x0c\r",
            b >= 0x80,
            c in ".!?,;:",
            c in "|<>{}[]\\/=_~^",
            c in "#*&%$@+",
            b < 0x80 and not c.isalnum() and b not in b" \t\n\x0b\x0c\r",
        ]
    return table


def statistics_of(text: bytes, classes: np.ndarray) -> list[float]:
    """The ``STATISTICS`` of one text; an empty one has zeros."""
    words = text.translate(WORD_BYTES).split()
    n, size = max(len(words), 1), max(len(text), 1)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer(text, dtype=np.uint8)
    shares = np.bincount(codes, minlength=256) @ classes / size
    digits, capitals, blanks, other, stops, bars, marks, symbols = shares.tolist()
    symbol = classes[codes, 7] > 0
    runs = int((symbol[2:] & symbol[1:-1] & symbol[:-2]).sum()) if len(codes) > 2 else 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        float(len(text)),
        float(len(words)),
        float(lengths.sum()) / n,
        float((lengths > 12).sum()) / n,
        float((lengths < 4).sum()) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(c == 1 for c in counts.values()) / n,
        symbols,
        digits,
        capitals,
        blanks,
        other,
        stops,
        bars,
        marks,
        runs / n,
        float(len(lines)),
        len(words) / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        len(zlib.compress(text, 1)) / size,
    ]


def with_statistics(docs: DataFrame, name: str, text_column: str = "text") -> DataFrame:
    """``docs`` without the text, with the struct ``name`` of statistics over the whole text."""
    rest = [f for f in docs.schema.fields if f.name != text_column]
    inner = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])
    at = docs.columns.index(text_column)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for batch in batches:
            rows = [statistics_of(t or b"", classes) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            table = np.array(rows, dtype=np.float64).reshape(-1, len(STATISTICS))
            found = pa.StructArray.from_arrays([pa.array(c) for c in table.T.copy()], names=STATISTICS)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, name])

    return docs.mapInArrow(measure, T.StructType([*rest, T.StructField(name, inner)]))


def _paths(node, above: tuple[Condition, ...] = ()) -> Iterator[tuple[Condition, ...]]:
    if above:
        yield above
    if "Internal" in node.getClass().getSimpleName():
        split = node.split()
        feature, bound = int(split.featureIndex()), float(split.threshold())
        yield from _paths(node.leftChild(), (*above, (feature, True, bound)))
        yield from _paths(node.rightChild(), (*above, (feature, False, bound)))


def holds(rule: tuple[Condition, ...], statistics: Column) -> Column:
    """Whether a row's statistics meet every comparison of a rule."""
    found = F.lit(True)
    for feature, at_most, bound in rule:
        value = statistics[STATISTICS[feature]]
        found = found & ((value <= bound) if at_most else (value > bound))
    return found


def fit_rules(measured: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> RuleModel:
    """Rules and weights from rows (doc_id, statistics) with a label outside fold 0.

    At most ``training_rows`` labelled rows take part; rows without label or id do not.
    Where only one label occurs there is no rule and every text scores its share.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").cast("double").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .filter(fold_of(F.col("doc_id")) != 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(training_rows)
    )
    training = measured.select("doc_id", "statistics").join(F.broadcast(chosen), "doc_id")  # at most training_rows
    training = stored(training.select("label", "statistics"), "quality-training")
    share = training.agg(F.sum("label").alias("ones"), F.count("*").alias("n")).first()
    ones, n = share.ones or 0.0, share.n
    if not 0 < ones < n:
        rate = (ones + 0.5) / (n + 1)
        return RuleModel([], float(np.log(rate / (1 - rate))))
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(
        training.select("label", "statistics.*")
    ).select("label", "features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", subsamplingRate=0.7, maxBins=64
    ).fit(vectors)
    rules = list(dict.fromkeys(path for tree in forest.trees for path in _paths(tree._call_java("rootNode"))))
    met = [holds(rule, F.col("statistics")).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)]
    table = stored(training.select("label", *met), "quality-rules")
    assembled = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(table)
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False
    ).fit(assembled.select("label", "features"))
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel([(r, w) for r, w in zip(rules, weights, strict=True) if w], float(lasso.intercept))


def rule_score(model: RuleModel, statistics: Column) -> Column:
    """The model as one column expression: a logistic sum of the weights of the rules that hold."""
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        total = total + F.when(holds(rule, statistics), F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with ``quality`` (score, statistics); underscores where taken.

    Null and empty texts have zero statistics and are scored like all others.  Repeated
    rows and rows without id are scored each.
    """
    name = free_name(docs, "quality")
    measured = stored(with_statistics(docs, name, text_column), "quality-statistics")
    keyed = measured.select(F.col(id_column).alias("doc_id"), F.col(name).alias("statistics"))
    model = fit_rules(keyed, labels)
    score = rule_score(model, F.col(name))
    return measured.withColumn(name, F.struct(score.alias("score"), F.col(name).alias("statistics")))
