"""Exact dedup: digests merged in rounds, sorted run by sorted run.

Texts are equal when they are identical after white space is deleted.  Each input
partition forms a run of (digest, best row, count).  In every round ``fan_in`` runs
of the same digest range meet, are sorted and merged, and only the best row of each
digest goes on; after log(runs) rounds one run is left for each range.  A digest
that a third of the rows carry is one row of each run after the first, map-side,
combine, so it loads no task.

Equality is taken from SHA-256 together with a 64-bit hash and the length of the
normalised text; all three must agree for two rows to meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import free_name, stored, whole_text

RUNS = 64
FAN_IN = 8
RANGE_DIGITS = 3


def digest_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    runs: int = RUNS,
    fan_in: int = FAN_IN,
    row_column: str | None = None,
) -> DataFrame:
    """One row per document: row, doc_id, keep_row, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id
    (null ids last), then the earliest row; so of repeated rows exactly one stays.
    A null text is empty; all texts without other characters are one group.  Other
    columns are not read.  ``row`` is ``row_column`` or, without one, numbers the rows
    within this call.
    """
    text = whole_text(text_column)
    normal = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    digests = stored(
        docs.select(
            (F.col(row_column) if row_column else F.monotonically_increasing_id()).alias("row"),
            F.col(id_column).alias("doc_id"),
            F.length(text).cast("long").alias("points"),
            normal.alias("normal"),
        ).select(
            "row",
            "doc_id",
            "points",
            F.sha2("normal", 256).alias("digest"),
            F.xxhash64("normal").alias("check"),
            F.octet_length("normal").alias("bytes"),
        ),
        "digests",
    )
    best = F.struct(
        (-F.col("points")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"
    )
    key = ["digest", "check", "bytes"]
    merged = (
        digests.select(
            F.substring("digest", 1, RANGE_DIGITS).alias("span"),
            (F.spark_partition_id() % runs).alias("run"),
            *key,
            best.alias("best"),
        )
        .groupBy("span", "run", *key)
        .agg(F.min("best").alias("best"), F.count(F.lit(1)).alias("copies"))
    )
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .repartition("span", "run")
            .sortWithinPartitions("span", "run", *key)
            .groupBy("span", "run", *key)
            .agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
        )
    kept = merged.select(
        *key,
        F.col("best.row").alias("keep_row"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
    )
    return digests.join(kept, key).select(
        "row",
        "doc_id",
        "keep_row",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row for each group of equal texts; all columns stay as they are.

    The rows are numbered and written once, so that the decision finds its row again
    whatever the ids are: null and repeated ids are allowed.
    """
    name = free_name(docs)
    numbered = stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    groups = digest_groups(numbered, id_column, text_column, row_column=name)
    stay = groups.filter("kept").select(F.col("row").alias(name))
    return numbered.join(stay, name, "left_semi").drop(name)
