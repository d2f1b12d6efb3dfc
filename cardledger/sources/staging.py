"""The already-loaded test and the one-off load of decoded folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardledger.sources.lines import malformed, scan_lines, split_lines


def stage_if_new(rows: DataFrame, loaded: DataFrame, keys: Sequence[str] = ("input_filename",)) -> DataFrame:
    """Rows of files that no earlier run loaded, by name and, if asked, header timestamp.

    The few distinct files of the feed meet the log; the rows then meet the fresh
    ones.  Rows are the left side of that join, so where Spark does not broadcast the
    fresh files the adaptive skew join cuts a file that holds a third of all rows.  A
    repeated header timestamp counts as a repeated file (Q14).
    """
    fresh = rows.select(*keys).distinct()
    for key in keys:
        fresh = fresh.join(loaded.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return rows.join(fresh, list(keys), "left_semi").select(*rows.columns)


def load_decoded_folder(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """A folder of ``;`` lines that already are rows of a staged table, and the lines that are none.

    The first frame has the columns of the table, the second (line, reason, input_filename):
    lines with another number of fields, or with a value that its column cannot hold.
    """
    split = split_lines(scan_lines(spark, path, latin1=False), keep_short=True)
    fields = [F.col("fields")[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    lost = F.lit(False)
    for i, f in enumerate(schema.fields):
        lost = lost | ((F.col("fields")[i] != "") & F.col(f"row.{f.name}").isNull())
    whole = split.filter(F.size("fields") == len(schema)).withColumn("row", F.struct(*fields))
    unreadable = whole.filter(lost).select("line", F.lit("unreadable value").alias("reason"), "input_filename")
    wrong = malformed(split, len(schema)).select("line", "reason", "input_filename")
    return whole.filter(~lost).select("row.*"), wrong.unionByName(unreadable)
