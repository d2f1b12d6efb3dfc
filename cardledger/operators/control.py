"""Control totals: rows in and out, ledger counts, stated against summed points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.functions import implied_points, stripped
from cardledger.operators.balances import CUSTOMER
from cardledger.operators.decode import is_enrolment_header
from cardledger.operators.pivots import MAINTENANCE_COMPANY
from cardledger.operators.routing import ACCEPTED, REJECTED
from cardledger.schemas import ENROLMENT_HEADER, POINTS_ACCOUNT_TOTAL, POINTS_TRANSACTION


def route_counts(routed: DataFrame) -> DataFrame:
    """All counts of one feed in a single aggregate."""

    def number(condition):
        return F.count_if(condition).cast("bigint")

    return routed.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_read"),
        number(F.col("route") == ACCEPTED).alias("rows_accepted"),
        number(F.col("route") == REJECTED).alias("rows_rejected"),
        number(F.col("product_company") != MAINTENANCE_COMPANY).alias("rows_of_other_company"),
    )


def unbalanced_movements(delta: DataFrame, balance: DataFrame) -> DataFrame:
    """Q30: accepted movements of customers without a balance row, from the counts of the delta."""
    return delta.join(balance.select(*CUSTOMER), CUSTOMER, "left_anti").agg(
        F.coalesce(F.sum("movements"), F.lit(0)).cast("bigint").alias("movements_without_balance")
    )


def ledger_check(before: int, added: int, after: int) -> dict:
    """Rows before plus rows added must be the rows after."""
    return {
        "ledger_before": before,
        "ledger_added": added,
        "ledger_after": after,
        "ledger_agrees": before + added == after,
    }


def record_counts(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Header record counter against the lines read, per file."""
    read = details.groupBy("input_filename").agg(F.count(F.lit(1)).alias("lines_read"))
    stated = headers.groupBy("input_filename").agg(
        F.max(F.col("record_counter").try_cast("bigint")).alias("lines_stated")
    )
    return stated.join(read, "input_filename", "full").select(
        "input_filename",
        "lines_stated",
        F.coalesce("lines_read", F.lit(0)).cast("bigint").alias("lines_read"),
        F.col("lines_stated").eqNullSafe(F.coalesce("lines_read", F.lit(0)).cast("bigint")).alias("counts_agree"),
    )


def enrolment_counts(lines: DataFrame, order: str = "line_order") -> DataFrame:
    """C6 from the lines themselves, as ``record_counts``: one scan and one aggregate of numbers per file."""
    start, end = ENROLMENT_HEADER["record_counter"]
    stated = F.when(is_enrolment_header(), stripped(F.substring("line", start + 1, end - start)).try_cast("bigint"))
    first_is_header = F.min(order) == F.min(F.when(is_enrolment_header(), F.col(order)))
    files = lines.groupBy("input_filename").agg(
        F.min_by(stated, order).alias("lines_stated"),
        (F.count(F.lit(1)) - F.when(first_is_header, 1).otherwise(0)).cast("bigint").alias("lines_read"),
    )
    return files.withColumn("counts_agree", F.col("lines_stated").eqNullSafe(F.col("lines_read")))


def stated_totals(account_totals: DataFrame, order: str = "line_order") -> DataFrame:
    """Stated points per programme and account, last record wins."""
    return account_totals.groupBy("programme", "account_number").agg(F.max_by("points", order).alias("stated_total"))


def summed_points(transactions: DataFrame) -> DataFrame:
    """Points of the transaction records per programme and account."""
    return transactions.groupBy("programme", "account_number").agg(
        F.sum("points").cast("bigint").alias("summed_total")
    )


def reconcile_points(lines: DataFrame, order: str = "line_order") -> DataFrame:
    """A7, A8, C5 from the lines of a points file, as ``points_reconcile``: one scan, one aggregate, no join.

    Account totals (18) and transactions (26) of an account meet in one group.
    """
    total = F.substring("line", 1, 2) == "18"

    def field(name: str, of_total: str, raw: bool = False):
        pieces = []
        for layout, column in ((POINTS_ACCOUNT_TOTAL, of_total), (POINTS_TRANSACTION, name)):
            start, end = layout[column]
            piece = F.substring("line", start + 1, end - start)
            pieces.append(piece if raw else stripped(piece))
        return F.when(total, pieces[0]).otherwise(pieces[1])

    points = implied_points(field("points", "points_added", raw=True))
    kept = lines.filter(F.substring("line", 1, 2).isin("18", "26")).select(
        field("programme", "programme").alias("programme"),
        field("account_number", "account_number").alias("account_number"),
        points.alias("points"),
        total.alias("total"),
        F.when(total, F.col(order)).alias("place"),
    )
    both = kept.groupBy("programme", "account_number").agg(
        F.max_by("points", "place").alias("stated_total"),
        F.sum(F.when(~F.col("total"), F.col("points"))).cast("bigint").alias("summed_total"),
    )
    left, right = F.coalesce("stated_total", F.lit(0)), F.coalesce("summed_total", F.lit(0))
    return both.withColumn("difference", (left - right).cast("bigint"))


def points_reconcile(stated: DataFrame, summed: DataFrame, keys: list[str]) -> DataFrame:
    """Both totals side by side, with their difference; an account in only one of them counts 0 in the other.

    Both sides are one row per account before they meet.
    """
    joined = stated.join(summed, keys, "full")
    left, right = F.coalesce("stated_total", F.lit(0)), F.coalesce("summed_total", F.lit(0))
    return joined.select(*keys, "stated_total", "summed_total", (left - right).cast("bigint").alias("difference"))
