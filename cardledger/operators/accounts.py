"""Card actions: what a status change means for partner, balances and master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions import action_id, date_part
from cardledger.operators.balances import CUSTOMER
from cardledger.schemas import ACTION_FILE

# The statuses that close a card, and per rule the three actions
# (master, bonus, extra bonus) the partner is told.
CLOSING = ("CB", "CT", "GD")
RULE_ACTIONS = {1: ("I", "", "B"), 2: ("D", "Z", "Z"), 3: ("U", "", "B"), 4: ("I", "", ""), 5: ("U", "", "")}
ACTION_COLUMNS = ("action_anagrafica", "action_bonus", "action_extrabonus")
CLOSING_RULE = 2


def action_rule(old: Column, new: Column) -> Column:
    """number of the rule for an (old, new) status pair, NULL when none applies.

    The rules exclude each other, so one chain stands for five filtered unions.
    """
    return (
        F.when(new == "KK", 1)
        .when(new.isin(*CLOSING), 2)
        .when(new.isin("KD", "JD") | ((old == "AA") & (new == "DD")), 3)
        .when((old == "") & (new == "AA"), 4)
        .when(old.isin("KK", "DD") & (new == "AA"), 5)
    )


def plastic_type(old: Column, new: Column) -> Column:
    """Card type in the action file; NULL keeps the row out of the file."""
    return F.when(new == "KK", "KK").when(new == "AA", "OL").when(old == "AA", "OL").when(old == "KK", "KK")


def with_actions(rows: DataFrame) -> DataFrame:
    """Rule, the three actions and the card type; rows without a rule are left out."""
    old, new = F.col("plastic_status_old"), F.col("plastic_status_new")
    ruled = rows.withColumn("action_rule", action_rule(old, new)).filter(F.col("action_rule").isNotNull())
    for place, name in enumerate(ACTION_COLUMNS):
        chain = F.when(F.lit(False), F.lit(""))
        for rule, actions in RULE_ACTIONS.items():
            chain = chain.when(F.col("action_rule") == rule, actions[place])
        ruled = ruled.withColumn(name, chain)
    return ruled.withColumn("plastic_type", plastic_type(old, new))


def in_action_file(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("plastic_type").isNotNull())


def _action_file(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    filled = {
        "data": date_part(F.col("elaboration_ts")),
        "actionid": action_id(
            F.col("appcode"), F.col("elaboration_ts"), F.col("product_company"), F.col("customer_number")
        ),
        **values,
    }
    return rows.select(*[filled.get(name, F.col(name)).alias(name) for name in ACTION_FILE])


def maintenance_actions(actions: DataFrame) -> DataFrame:
    """The 29 fields for accepted maintenance rows; address and contact fields stay empty."""
    empty = (
        "customer_address customer_city customer_state zip country_cod date_birth home_tel work_tel "
        "city_birth gender nationality email"
    ).split()
    values = {name: F.lit("") for name in empty}
    for name in ("cup", "livrea", "convenzione", "dealer"):
        values[name] = F.col(f"{name}_new")
    values["customer_name"] = F.col("customer_name_an")
    values["customer_surname"] = F.col("customer_surname_an")
    return _action_file(in_action_file(actions), values)


def enrolment_actions(accounts: DataFrame) -> DataFrame:
    """The 29 fields for new accounts, action ``I``, card columns empty."""
    values = {name: F.lit("") for name in ("cup", "livrea", "convenzione", "dealer", "plastic_type")}
    values |= {"action_anagrafica": F.lit("I"), "action_bonus": F.lit(""), "action_extrabonus": F.lit("")}
    return _action_file(accounts, values)


def closing_customers(actions: DataFrame, order: str = "elaboration_ts") -> DataFrame:
    """Customers of rule-2 rows, one action each: the latest, then the smallest status (Q10).

    Rows the file drops for want of a card type close all the same.  The group
    is a ``min`` over a short struct, combined in each task before the shuffle.
    """
    latest_first = -F.coalesce(F.col(order).try_cast("bigint"), F.lit(0))
    best = F.min(
        F.struct(
            latest_first.alias("rank"),
            F.col("plastic_status_new").alias("status"),
            F.col(order).cast("string").alias("at"),
        )
    )
    return (
        actions.filter(F.col("action_rule") == CLOSING_RULE)
        .groupBy(*CUSTOMER)
        .agg(best.alias("best"))
        .select(
            *CUSTOMER, F.col("best.status").alias("plastic_status_new"), F.col("best.at").alias("closing_ts")
        )
    )


def account_disable(master: DataFrame, closing: DataFrame) -> DataFrame:
    """Closed customers and all their accounts go inactive and take status and run timestamp of the action."""
    marks = closing.select(
        *CUSTOMER, F.col("plastic_status_new").alias("_status"), F.col("closing_ts").alias("_ts")
    )
    closed = F.col("_status").isNotNull()
    joined = master.join(marks, CUSTOMER, "left")
    changes = {
        "is_customer_number_active": F.when(closed, False).otherwise(F.col("is_customer_number_active")),
        "is_account_number_active": F.when(closed, False).otherwise(F.col("is_account_number_active")),
        "customer_status": F.coalesce("_status", "customer_status"),
        "account_status": F.coalesce("_status", "account_status"),
        "elaboration_ts": F.coalesce("_ts", "elaboration_ts"),
    }
    return joined.withColumns(changes).select(*master.columns)
