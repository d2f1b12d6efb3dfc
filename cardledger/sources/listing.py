"""Which input files wait, and which staged file a table holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def waiting_files(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Names, paths and sizes of the files that start with ``prefix``; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", prefix + "*")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("input_filename"), "path", "length")
    )


def name_timestamp(file_name: Column, prefix_length: int, timestamp_length: int) -> Column:
    """The timestamp that follows the fixed prefix of a file name."""
    return F.substring(file_name, prefix_length + 1, timestamp_length)


# The other listing takes the timestamp from characters 7 to 24 of the name.
LISTED_TIMESTAMP = (7, 17)


def oldest_file(files: DataFrame, prefix_length: int, timestamp_length: int) -> DataFrame:
    """The first file by name, with both timestamp readings; empty when none waits."""
    return (
        files.orderBy("input_filename")
        .limit(1)
        .withColumn("input_filename_timestamp", name_timestamp(F.col("input_filename"), prefix_length, timestamp_length))
        .withColumn("listed_timestamp", name_timestamp(F.col("input_filename"), *LISTED_TIMESTAMP))
    )


def staged_file_name(staged: DataFrame) -> DataFrame:
    """The input file of a staged table, the smallest name so that the answer is repeatable.

    ``min`` combines in each task, so one short row per task is shuffled.
    """
    return staged.agg(F.min("input_filename").alias("input_filename")).filter(F.col("input_filename").isNotNull())
