"""Text scans: fixed-width lines in Latin-1 and delimited lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.schemas import MOVEMENT_FIELDS


def scan_lines(spark: SparkSession, path: str | list[str], latin1: bool = True) -> DataFrame:
    """One row per line with its file and its place in the file.

    ``line_order`` is (first byte of the split, running number): splits of many
    files may be packed into one task, so the running number alone is no file
    order, but inside one split it rises with the line.  Big files stay
    splittable and no file is held whole anywhere.
    """
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1") if latin1 else F.col("value")
    return spark.read.text(path).select(
        text.alias("line"),
        F.col("_metadata.file_name").alias("input_filename"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        ).alias("line_order"),
    )


def single_backslashes(lines: DataFrame) -> DataFrame:
    """Two backslashes in the file stand for one."""
    return lines.withColumn("line", F.replace(F.col("line"), F.lit("\\\\"), F.lit("\\")))


def split_lines(lines: DataFrame, delimiter: str = ";", keep_short: bool = False) -> DataFrame:
    """S3: fields of every delimited line, no quoting; lines with fewer than two fields are dropped unless kept."""
    split = lines.withColumn("fields", F.split("line", "\\" + delimiter, -1))
    return split if keep_short else split.filter(F.size("fields") > 1)


def well_formed(split: DataFrame, names: Sequence[str] = MOVEMENT_FIELDS) -> DataFrame:
    """Lines with exactly the expected number of fields, one column per field (Q23)."""
    keep = [c for c in split.columns if c not in ("line", "fields")]
    return split.filter(F.size("fields") == len(names)).select(
        *[F.col("fields")[i].alias(name) for i, name in enumerate(names)], *keep
    )


def malformed(split: DataFrame, expected: int = len(MOVEMENT_FIELDS)) -> DataFrame:
    """Lines with another number of fields: rejects, never shifted into the wrong columns (Q23)."""
    return split.filter(F.size("fields") != expected).drop("fields").withColumn("reason", F.lit("field count"))


def with_run_columns(fields: DataFrame, name_prefix_length: int, timestamp_length: int, run_ts: str) -> DataFrame:
    """File name, its timestamp and the run timestamp go between the 11th and the 12th field."""
    first, last = MOVEMENT_FIELDS[:11], MOVEMENT_FIELDS[11:]
    return fields.select(
        *first,
        "input_filename",
        F.substring("input_filename", name_prefix_length + 1, timestamp_length).alias("input_filename_timestamp"),
        F.lit(run_ts).alias("elaboration_ts"),
        *last,
    )
