"""Fixed-width records to columns: one projection per record type, no user function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions import (
    century_date,
    day_first_date,
    implied_points,
    implied_points_text,
    overpunch_sign,
    posted_amount,
    stripped,
)
from cardledger.schemas import (
    ENROLMENT_DETAIL,
    ENROLMENT_HEADER,
    MAINTENANCE_DETAIL,
    POINTS_ACCOUNT_TOTAL,
    POINTS_HEADER,
    POINTS_TRANSACTION,
    STAGED_POINTS,
    Layout,
    conform,
)

# Fixed values of every row staged from the mainframe feeds.
MAINFRAME_APPCODE = "CAMS"
POINTS_TYPE = "VC"
POINTS_CURRENCY = "EUR"
POINTS_CAUSAL_CODE = "GT"
HEADER_TIME = "0000000"

# The text a points row carries beside its code; a run may give its own.
POINTS_CAUSAL = "Buoni sconto per utilizzo carta"


def cut(layout: Layout, *, raw: tuple[str, ...] = ()) -> list[Column]:
    """One column per layout field, trimmed unless named in ``raw``."""
    columns = []
    for name, (start, end) in layout.items():
        piece = F.substring("line", start + 1, end - start)
        columns.append((piece if name in raw else stripped(piece)).alias(name))
    return columns


def _others(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c != "line"]


# ---- enrolment ------------------------------------------------------------


def is_enrolment_header() -> Column:
    """D1, for the first line of a file: only there is an ``H`` in tenth place a header."""
    return F.substring("line", 10, 1) == "H"


def file_heads(lines: DataFrame, order: str = "line_order") -> DataFrame:
    """One row per file: the place of its first line, and that line where it is a header.  One scan."""
    header = F.when(is_enrolment_header(), F.struct("line", *_others(lines)))
    narrow = lines.select(F.col("input_filename"), F.col(order).alias("_order"), header.alias("_line"))
    return narrow.groupBy("input_filename").agg(
        F.min("_order").alias("_first"), F.min_by("_line", "_order").alias("_header")
    )


def enrolment_headers(lines: DataFrame, order: str = "line_order") -> DataFrame:
    """Header fields of the files whose first line is a header."""
    headers = file_heads(lines, order).filter("_header IS NOT NULL").select("_header.*")
    return headers.select(*cut(ENROLMENT_HEADER), *_others(lines))


def enrolment_details(lines: DataFrame, order: str = "line_order", batch_as: str | None = None) -> DataFrame:
    """D3: the eight fields of every line that is no header; with ``batch_as`` also the batch of its file's header.

    One scan of the lines meets one row per file, on the left side: a file with most lines can be cut.
    """
    heads = file_heads(lines, order).select("input_filename", "_first", F.col("_header.line").alias("_header"))
    met = lines.join(heads, "input_filename", "left")
    details = met.filter(~(is_enrolment_header() & (F.col(order) == F.col("_first"))))
    columns = [*cut(ENROLMENT_DETAIL), *_others(lines)]
    if batch_as:
        start, end = ENROLMENT_HEADER["batch_id"]
        columns.append(stripped(F.substring("_header", start + 1, end - start)).alias(batch_as))
    return details.select(*columns)


# ---- points ---------------------------------------------------------------


def _of_type(lines: DataFrame, record_type: str) -> DataFrame:
    return lines.filter(F.substring("line", 1, 2) == record_type)


def points_headers(lines: DataFrame) -> DataFrame:
    """Header with the batch timestamp, the day followed by seven zeros."""
    fields = _of_type(lines, "06").select(*cut(POINTS_HEADER), *_others(lines))
    day = day_first_date(F.col("current_date"))
    return fields.withColumn("file_date", day).withColumn("internallog_ts", F.concat(day, F.lit(HEADER_TIME)))


def points_account_totals(lines: DataFrame) -> DataFrame:
    """Account totals; ``points`` is NULL where the overpunch is malformed."""
    fields = _of_type(lines, "18").select(*cut(POINTS_ACCOUNT_TOTAL, raw=("points_added",)), *_others(lines))
    return (
        fields.withColumn("points", implied_points(F.col("points_added")))
        .withColumn("cycle_end_date", century_date(F.col("cycle_end")))
        .withColumn("award_cycle_date", century_date(F.col("award_cycle")))
    )


def points_transactions(lines: DataFrame) -> DataFrame:
    """Transaction records of one scan; other record types are left out."""
    fields = _of_type(lines, "26").select(*cut(POINTS_TRANSACTION, raw=("points", "posted_amount")), *_others(lines))
    return (
        fields.withColumnRenamed("points", "points_raw")
        .withColumn("points", implied_points(F.col("points_raw")))
        .withColumn("transaction_day", century_date(F.col("transaction_date")))
        .withColumn("posting_day", century_date(F.col("posting_date")))
    )


def first_headers(headers: DataFrame, column: str, order: str = "line_order") -> DataFrame:
    """A header field per file, of the header that stands first; a file should have one."""
    return headers.groupBy("input_filename").agg(F.min_by(column, order).alias(column))


def with_header_value(
    rows: DataFrame, headers: DataFrame, column: str = "internallog_ts", order: str = "line_order"
) -> DataFrame:
    """A header field on every row of the same file (NULL without header).

    Rows are the left side of the join with one row per file: where Spark does not
    broadcast the headers, the adaptive skew join cuts a file with most rows.
    """
    return rows.join(first_headers(headers, column, order), "input_filename", "left")


def staged_points(transactions: DataFrame, run_ts: str, causal: str = POINTS_CAUSAL) -> DataFrame:
    """Transaction records as the 17 columns of the staged table (Q1, Q2, Q21).

    Needs ``input_filename``, ``input_filename_timestamp`` and ``internallog_ts``.
    A malformed overpunch leaves ``sign`` and ``value`` NULL, so routing rejects the row (Q19).
    """
    return conform(
        transactions.select(
            F.lit(MAINFRAME_APPCODE).alias("appcode"),
            "product_company",
            "account_number",
            F.col("programme").alias("loyalty_program_cod"),
            F.concat("reference_number", "category").alias("transaction_id"),
            F.col("transaction_day").alias("transaction_date"),
            posted_amount(F.col("posted_amount")).alias("transaction_value"),
            F.lit(POINTS_TYPE).alias("transaction_type"),
            overpunch_sign(F.col("points_raw")).alias("sign"),
            F.lit(POINTS_CURRENCY).alias("currency"),
            implied_points_text(F.col("points_raw")).alias("value"),
            F.lit(causal).alias("causal"),
            F.lit(POINTS_CAUSAL_CODE).alias("causalcode"),
            "input_filename",
            "input_filename_timestamp",
            F.lit(run_ts).alias("elaboration_ts"),
            "internallog_ts",
        ),
        STAGED_POINTS,
    )


# ---- maintenance ----------------------------------------------------------


def maintenance_details(lines: DataFrame) -> DataFrame:
    """The ten fields; the batch timestamp is the one in the file name."""
    fields = lines.select(*cut(MAINTENANCE_DETAIL), *_others(lines))
    if "input_filename_timestamp" in fields.columns:
        fields = fields.withColumn("internallog_ts", F.col("input_filename_timestamp"))
    return fields
