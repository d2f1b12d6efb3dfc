"""Rows of the output files, ledger rows, and the text sink."""

from __future__ import annotations

from pyspark.errors import IllegalArgumentException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardledger.functions import (
    document_line,
    joined_fields,
    partner_transaction_units,
    partner_value_units,
    typed_date,
)
from cardledger.schemas import RESPONSE_FILE, TRANSACTION, TRANSACTION_FILE, conform

# Fixed values of the response file name: characters kept of the input name, and the ending.
RESPONSE_NAME_LENGTH = 30
RESPONSE_SUFFIX = "_SIAResponse.csv"

# Programme code a ledger row carries when its feed has none.
PARTNER_PROGRAMME = "0"
SAVEBACK_PROGRAMME = ""


def with_partner_units(rows: DataFrame) -> DataFrame:
    """``transaction_value`` and ``value`` in the units of file and ledger, both from the sent value."""
    kind, sent = F.col("transaction_type"), F.col("value")
    return rows.withColumns(
        {"transaction_value": partner_transaction_units(kind, sent), "value": partner_value_units(kind, sent)}
    )


def transaction_file(movements: DataFrame) -> DataFrame:
    """The 13 fields of the partner's transaction file."""
    return movements.select(*TRANSACTION_FILE)


def response_file(response: DataFrame) -> DataFrame:
    """P5, O1: the 14 fields of the response file in a total order.

    A range sort on the whole key: rows of one customer may lie in several parts.
    """
    return response.select(*RESPONSE_FILE).orderBy("customer_number", "transaction_id", "response_code")


def response_file_name(input_filename: Column) -> Column:
    """K9."""
    return F.concat(F.substring(input_filename, 1, RESPONSE_NAME_LENGTH), F.lit(RESPONSE_SUFFIX))


def run_file_name(prefix: str, run_ts: str) -> str:
    """K9."""
    return f"{prefix}{run_ts}.csv"


def document_lines(rows: DataFrame) -> DataFrame:
    """K7: rows as ``;`` lines."""
    return rows.select(document_line([F.col(name) for name in rows.columns]).alias("value"))


def raw_lines(rows: DataFrame) -> DataFrame:
    """Rows as ``;`` lines exactly as sent, delimiters inside values included."""
    return rows.select(joined_fields([F.col(name) for name in rows.columns]).alias("value"))


def write_document(rows: DataFrame, path: str) -> int:
    """K7, K8: a folder of text parts without header, ``;`` between fields (Q13).

    The parts in name order are the file.  Nothing is coalesced into one task
    or sent to the driver; whoever delivers the file joins the parts.  Returns
    the number of delimiters that were replaced inside values, observed in the
    tasks that write, so the rows are read once.
    """
    seen = Observation()
    watched = rows.observe(seen, F.coalesce(F.sum(values_with_delimiter(rows)), F.lit(0)).alias("replaced"))
    write_sorted_document(watched, path)
    return seen.get["replaced"]


def deliver(spark: SparkSession, folder: str, path: str) -> bool:
    """K7, K8, Q13: the parts of a document as one file of the given name, joined by the file system itself.

    HDFS links the blocks of the parts together; a document of one part is renamed on any file
    system.  No byte passes a task or the driver.  Where the file system cannot join files, or
    an empty part stands among them that it refuses, nothing changes and False says so: the
    folder is delivered with ``hadoop fs -getmerge``, which joins its parts in the same order.
    """
    gateway, context = spark.sparkContext._gateway, spark.sparkContext
    name = context._jvm.org.apache.hadoop.fs.Path
    files = name(path).getFileSystem(context._jsc.hadoopConfiguration())
    listed = [f for f in files.listStatus(name(folder)) if f.getPath().getName().startswith("part-")]
    parts = sorted((f.getPath() for f in listed if f.getLen()), key=lambda p: p.getName())
    if files.exists(name(path)):
        raise FileExistsError(path)
    if not parts:
        return bool(files.createNewFile(name(path)))
    if len(parts) > 1:
        rest = gateway.new_array(name, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            rest[i] = part
        try:
            files.concat(parts[0], rest)
        except (UnsupportedOperationException, IllegalArgumentException):
            return False
    return bool(files.rename(parts[0], name(path)))


def write_sorted_document(rows: DataFrame, path: str) -> None:
    """K7 without the count: for sorted rows, which a sort samples and so reads twice."""
    document_lines(rows).write.mode("overwrite").text(path)


def values_with_delimiter(rows: DataFrame, delimiter: str = ";") -> Column:
    """Q17: number of values of a row in which the delimiter was replaced."""
    hits = [F.when(F.contains(F.col(c).cast("string"), F.lit(delimiter)), 1).otherwise(0) for c in rows.columns]
    return sum(hits[1:], hits[0])


def ledger_rows(movements: DataFrame, programme: str | None = None) -> DataFrame:
    """Movements as rows of the transaction ledger, matched by name (Q24).

    A feed without transaction value books 0 (Q3).
    """
    rows = movements
    if programme is not None:
        rows = rows.withColumn("loyalty_program_cod", F.lit(programme))
    if "transaction_value" not in rows.columns:
        rows = rows.withColumn("transaction_value", F.lit(0))
    return conform(
        rows.withColumn("transaction_value", F.col("transaction_value").cast("decimal(18,2)")).withColumn(
            "value", F.col("value").try_cast("decimal(18,3)")
        ),
        TRANSACTION,
    )


def transaction_month(transaction_date: Column) -> Column:
    """Partition value of a ledger row; all texts that are no date share one partition."""
    return F.coalesce(F.date_format(typed_date(transaction_date), "yyyyMM"), F.lit("undated"))
