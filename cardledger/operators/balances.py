"""Signed points and the balance ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardledger.functions import partner_balance_points, signed_amount, transaction_key

CUSTOMER = ["product_company", "customer_number"]
BALANCE_COLUMNS = ("balance_extrabonus", "balance_virtualcredit")
BALANCE_TYPE = "decimal(18,3)"


def movements(accepted: DataFrame) -> DataFrame:
    """Accepted rows under the master's customer number and a global id."""
    rows = accepted
    if "master_customer_number" in rows.columns:
        rows = rows.withColumn("customer_number", F.col("master_customer_number")).drop("master_customer_number")
    return rows.withColumn(
        "transaction_id",
        transaction_key(
            F.col("appcode"), F.col("transaction_id"), F.col("transaction_date"), F.col("input_filename_timestamp")
        ),
    )


def signed_points(rows: DataFrame) -> DataFrame:
    """Signed points per customer and movement type.

    The sum is combined in each task before the shuffle, so a customer with a
    third of all movements sends one row per task.
    """
    return rows.groupBy(*CUSTOMER, "transaction_type").agg(
        F.sum(signed_amount(F.col("sign"), F.col("value"))).cast("decimal(28,3)").alias("points")
    )


def movement_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """both signed sums and the number of movements per key, in one aggregate and one shuffle."""
    amount = signed_amount(F.col("sign"), F.col("value"))

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("transaction_type") == kind, amount)), F.lit(0)).cast("decimal(28,3)")

    return rows.groupBy(*keys).agg(
        total("VC").alias("points_virtualcredit"),
        total("E").alias("points_extrabonus"),
        F.count(F.lit(1)).alias("movements"),
    )


def _as_delta(sums: DataFrame, from_partner: bool) -> DataFrame:
    credit = F.col("points_virtualcredit")
    return sums.select(
        *CUSTOMER,
        (partner_balance_points(credit) if from_partner else credit.cast("decimal(28,6)")).alias("delta_virtualcredit"),
        F.col("points_extrabonus").cast("decimal(28,6)").alias("delta_extrabonus"),
        "movements",
    )


def balance_delta(rows: DataFrame, from_partner: bool = False) -> DataFrame:
    """Movements to one row per customer with what each balance gains.

    Only the partner feed counts virtual credit in thousandths (Q25).
    """
    return _as_delta(movement_sums(rows, CUSTOMER), from_partner)


def balance_update(balance: DataFrame, delta: DataFrame, matched: Observation | None = None) -> DataFrame:
    """Add both deltas in one pass; a NULL balance stays NULL (Q20), other customers are unchanged.

    ``elaboration_ts`` of a balance row is left alone (Q27).  ``matched`` counts
    the movements that met a balance while the result is written.
    """

    def moved(kind: str) -> Column:
        return (F.col(f"balance_{kind}") + F.coalesce(f"delta_{kind}", F.lit(0))).cast(BALANCE_TYPE)

    joined = balance.join(delta, CUSTOMER, "left")
    if matched is not None:
        joined = joined.observe(matched, F.coalesce(F.sum("movements"), F.lit(0)).alias("movements"))
    return joined.withColumns(
        {f"balance_{kind}": moved(kind) for kind in ("extrabonus", "virtualcredit")}
    ).select(*balance.columns)


def balance_close(balance: DataFrame, closing: DataFrame) -> DataFrame:
    """Both balances of closed customers become 0, and so does every NULL (Q20).

    ``closing`` has one row per customer (``accounts.closing_customers``).
    """
    closed = closing.select(*CUSTOMER).distinct().withColumn("_closed", F.lit(True))
    zero = F.lit(0).cast(BALANCE_TYPE)
    joined = balance.join(closed, CUSTOMER, "left")
    return joined.withColumns(
        {
            name: F.when(F.col("_closed"), zero).otherwise(F.coalesce(F.col(name), zero)).cast(BALANCE_TYPE)
            for name in BALANCE_COLUMNS
        }
    ).select(*balance.columns)


def balance_zero_all(balance: DataFrame, column: str) -> DataFrame:
    """L3: a balance column to 0 everywhere; for tests."""
    if column not in BALANCE_COLUMNS:
        raise ValueError(f"no balance column: {column}")
    return balance.withColumn(column, F.lit(0).cast(BALANCE_TYPE))


def open_balances(new_accounts: DataFrame, balance: DataFrame, run_ts: str) -> DataFrame:
    """A 0/0 row for every customer among the new accounts that has none yet (Q11)."""
    customers = new_accounts.groupBy(*CUSTOMER).agg(F.min("customer_company").alias("customer_company"))
    zero = F.lit(0).cast(BALANCE_TYPE)
    return customers.join(balance.select(*CUSTOMER), CUSTOMER, "left_anti").select(
        "customer_company",
        *CUSTOMER,
        zero.alias("balance_extrabonus"),
        zero.alias("balance_virtualcredit"),
        F.lit(run_ts).alias("elaboration_ts"),
    )
