"""Helpers that the operators share: stored intermediate tables, held-out rows, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardledger.session import scratch_folder

#: Characters that count as white space in the contracts: blank and \x09 to \x0D.
WHITE_SPACE = " \t\n\x0b\x0c\r"

#: Lower-cases A-Z and blanks every other ASCII byte that is neither letter nor digit;
#: bytes of other characters stay.  ``text.translate(WORD_BYTES).split()`` gives the words.
WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

#: Bytes that a numpy pass handles at once; a longer text is a batch of its own.
BATCH_BYTES = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read again.

    Cuts the lineage: a lost executor repeats a read, not the work before it, and
    generated row ids are fixed.  The reread table has a known size, by which Spark
    itself picks broadcast or shuffle joins.
    """
    folder = scratch_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(docs: DataFrame, name: str = "row_number") -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_batches(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) in runs of at most ``limit`` bytes, a longer text alone."""
    texts: list[bytes] = []
    first = size = 0
    for i, text in enumerate(column.cast(pa.binary()).to_pylist()):
        text = text or b""
        if texts and size + len(text) > limit:
            yield first, texts
            texts, first, size = [], i, 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for undirected edges (a, b): the smallest node that each one reaches.

    Each round gives every node the smallest label around it and then takes the label
    of that label, so the rounds grow with the logarithm of the longest path.  Each
    round is a written table; the driver sees one count per round.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(),
        f"{label}-edges",
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component"))
    labels = stored(labels, f"{label}-0")
    for step in range(1, 200):
        moved = Observation()
        around = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .select(F.col("a").alias("node"), "component", F.lit(None).cast("bigint").alias("before"))
            .union(labels.select("node", "component", F.col("component").alias("before")))
            .groupBy("node")
            .agg(F.min("component").alias("near"), F.max("before").alias("before"))
        )
        own = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        fresh = around.join(own, "near", "left").select("node", F.least("near", "far").alias("component"), "before")
        fresh = fresh.observe(moved, F.count_if(F.col("component") != F.col("before")).alias("n"))
        labels = stored(fresh, f"{label}-{step}").select("node", "component")
        if not moved.get["n"]:
            return labels
    raise RuntimeError("components did not settle")
