"""Match a feed with the account master and give every row one route.

Each feed is joined once and gets the columns ``route`` (accepted or rejected)
and ``reason``; the seven filters over one join become one expression.  The
feed is the left side and the master is unique by key, so rows are neither
multiplied nor lost, and a hot account is cut by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions import signed_amount, transaction_key

ACCEPTED = "accepted"
REJECTED = "rejected"

UNKNOWN = "unknown account"
INACTIVE = "inactive"
UNKNOWN_STATE = "unknown state"
BAD_AMOUNT = "bad amount"
IN_LEDGER = "already in ledger"
IN_MASTER = "already in master"
REPEATED = "repeated account"

# Fixed values of the partner response: code, text and the accepted field values.
RESPONSE_TEXTS = {
    "00": "Elaborato Con Successo",
    "01": "CustomerNumber Inesistente",
    "02": "CustomerNumber Non Attivo",
    "03": "ApplicationCode Non Valido",
    "04": "ClientNumber Non Valido",
    "05": "Type Non Valido",
    "06": "CausalCode Non Valido",
}
# The engine's own answer to a movement whose value is no number: it is not booked.
BAD_AMOUNT_CODE, BAD_AMOUNT_TEXT = "07", "Value Non Valido"
PARTNER_APPCODE = "CHP"
PARTNER_COMPANY = "18200"
MOVEMENT_TYPES = ("VC", "E")
PARTNER_CAUSALS = ("BB", "DA", "PC", "PB", "CC", "WB")


def match_master(
    feed: DataFrame, master: DataFrame, keys: dict[str, str], carry: Sequence[str], stored: bool = False
) -> DataFrame:
    """Left join of feed columns to master columns; carried master columns end in ``_an``.

    A ``stored`` master lies in sorted buckets of its key.  The feed's distinct keys are looked
    up there first: the keys move to the buckets, the master stays where it is.  The feed
    then meets the few rows found; a hash beside the key makes that a join of its own, so
    that a hot account is cut there and never lands in one bucket's task.
    """
    names = list(dict.fromkeys([*keys.values(), *carry]))
    right = master.select(*[F.col(name).alias(f"{name}_an") for name in names])
    ours, theirs = list(keys), [f"{name}_an" for name in keys.values()]
    condition = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(ours, theirs, strict=True)])
    if not stored:
        return feed.join(right, condition, "left")
    asked = feed.select(*[F.col(a).alias(f"_{b}") for a, b in zip(ours, theirs, strict=True)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"_{b}") == F.col(b) for b in theirs])
    found = asked.join(right, same).select(*right.columns, F.xxhash64(*theirs).alias("_number_an"))
    numbered = feed.withColumn("_number", F.xxhash64(*ours))
    return numbered.join(found, condition & (F.col("_number") == F.col("_number_an")), "left").drop("_number", "_number_an")


def _with_route(matched: DataFrame, reason: Column) -> DataFrame:
    return matched.withColumn("reason", reason).withColumn(
        "route", F.when(F.col("reason").isNull(), ACCEPTED).otherwise(REJECTED)
    )


def _activity_reason(key: str, active: str = "is_customer_number_active_an") -> Column:
    """found and active, or the reason why not; a NULL flag is a reject, not a lost row (Q6)."""
    amount = signed_amount(F.col("sign"), F.col("value"))
    return (
        F.when(F.col(key).isNull(), UNKNOWN)
        .when(F.col(active).isNull(), UNKNOWN_STATE)
        .when(~F.col(active), INACTIVE)
        .when(amount.isNull(), BAD_AMOUNT)
    )


def _routed_by_account(feed: DataFrame, master: DataFrame, account_column: str, stored: bool) -> DataFrame:
    matched = match_master(
        feed,
        master,
        {"product_company": "product_company", account_column: "account_number"},
        ["customer_number", "is_customer_number_active"],
        stored,
    )
    return _with_route(matched, _activity_reason("account_number_an")).select(
        *feed.columns, F.col("customer_number_an").alias("master_customer_number"), "route", "reason"
    )


def route_points(feed: DataFrame, master: DataFrame, stored: bool = False) -> DataFrame:
    """J3, F1, F2; ``stored`` as in ``match_master``."""
    return _routed_by_account(feed, master, "account_number", stored)


def route_partner(feed: DataFrame, master: DataFrame, stored: bool = False) -> DataFrame:
    """The feed's customer number really is an account number."""
    return _routed_by_account(feed, master, "customer_number", stored)


def route_maintenance(staged: DataFrame, master: DataFrame, stored: bool = False) -> DataFrame:
    """Accepted when the account is in the master, active or not; names and tax id come from there."""
    matched = match_master(
        staged,
        master,
        {"product_company": "product_company", "account_number": "account_number"},
        ["customer_number", "customer_name", "customer_surname", "taxid_number"],
        stored,
    )
    reason = F.when(F.col("account_number_an").isNull(), UNKNOWN)
    kept = [F.col("customer_number_an").alias(c) if c == "customer_number" else F.col(c) for c in staged.columns]
    return _with_route(matched, reason).select(
        *kept,
        "customer_name_an",
        "customer_surname_an",
        F.col("taxid_number_an").alias("taxid_number"),
        "route",
        "reason",
    )


def route_enrolment(staged: DataFrame, master: DataFrame) -> DataFrame:
    """Accepted when company and account are not in the master and only once in the file.

    The customer is no part of the key: an account of two customers would book each of its
    movements twice.  All rows of an account that a file brings more than once are
    rejected, for nothing tells which is right.  A missing key part matches nothing, as in
    an anti join.
    """
    keys = ["product_company", "account_number"]
    # Counts and master rows meet per account first, combined in the tasks; a repeated account
    # is one row there, and the adaptive join may cut it where the file's rows come in.
    counted = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("product_company IS NOT NULL AND account_number IS NOT NULL")
    known = master.select(*keys).distinct().withColumn("_known", F.lit(True))
    states = counted.join(known, keys, "left").withColumn("_number", F.xxhash64(*keys))
    matched = staged.withColumn("_number", F.xxhash64(*keys)).join(states, [*keys, "_number"], "left")
    whole = F.col("product_company").isNotNull() & F.col("account_number").isNotNull()
    reason = F.when(F.col("_known"), IN_MASTER).when(whole & (F.col("_rows") > 1), REPEATED)
    return _with_route(matched, reason).select(*staged.columns, "route", "reason")


def customers_of(master: DataFrame) -> DataFrame:
    """Q8: one row per customer, active if any of its accounts is."""
    return master.groupBy("product_company", "customer_number").agg(
        F.bool_or("is_customer_number_active").alias("is_customer_number_active")
    )


def route_saveback(feed: DataFrame, master: DataFrame, ledger: DataFrame, mark_resent: bool = False) -> DataFrame:
    """As points, but by customer, and rejected when the ledger has the movement.

    Ids are rewritten first, for the ledger holds rewritten ids (Q9).  With
    ``mark_resent`` the column ``sent_before`` tells whether any file brought
    the same movement; that reads the ledger a second time and rejects nothing.
    """
    customer = ["product_company", "customer_number"]
    movement = [F.col("appcode"), F.col("transaction_id"), F.col("transaction_date")]
    columns = list(feed.columns)

    def in_ledger(rows: DataFrame, ids: Column, key: str, flag: str) -> DataFrame:
        # One left join with the distinct booked ids that the feed asks for: the months'
        # ids are filtered by the feed's numbers first, where they are read if the feed is
        # small.  The ids are long texts with equal beginnings; a number ahead of them
        # makes the sorts cheap.
        number = F.xxhash64(*customer, key).alias("_number")
        keys = ["_number", key, *customer]
        booked = ledger.select(*customer, ids.alias(key)).select("*", number)
        known = booked.join(numbered_feed.select(number).distinct(), "_number", "left_semi").distinct()
        numbered = rows.withColumn("_number", number)
        return numbered.join(known.withColumn(flag, F.lit(True)), keys, "left").drop("_number")

    numbered_feed = feed.withColumn("_ledger_id", transaction_key(*movement, F.col("input_filename_timestamp")))
    if mark_resent:
        numbered_feed = numbered_feed.withColumn("_movement_id", transaction_key(*movement))
    matched = match_master(
        numbered_feed,
        customers_of(master),
        {name: name for name in customer},
        ["is_customer_number_active"],
    )
    matched = in_ledger(matched, F.col("transaction_id"), "_ledger_id", "_booked")
    if mark_resent:
        bare = F.left("transaction_id", F.length("transaction_id") - F.length("input_filename_timestamp") - 1)
        matched = in_ledger(matched, bare, "_movement_id", "_sent").withColumn(
            "sent_before", F.coalesce("_sent", F.lit(False))
        )
        columns.append("sent_before")
    reason = F.coalesce(_activity_reason("customer_number_an"), F.when(F.col("_booked"), IN_LEDGER))
    return _with_route(matched, reason).select(*columns, "route", "reason")


def accepted(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == ACCEPTED)


def rejected(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == REJECTED)


def reject_union(*routed: DataFrame) -> DataFrame:
    """Rejects of several feeds, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rejected(one) for one in routed])


def partner_response(routed: DataFrame) -> DataFrame:
    """One row per response code that applies to a movement, in one pass over the routed rows.

    Only a booked row is answered 00, and every row gets an answer: one of unknown state
    counts as not active, one whose value is no number gets a code of its own.  Codes
    03-06 do not reject, so a row may carry 00 and 03; NULL breaches no rule (Q7).
    """
    reason = F.coalesce("reason", F.lit(""))
    rules = {
        "00": reason == "",
        "01": reason == UNKNOWN,
        "02": reason.isin(INACTIVE, UNKNOWN_STATE),
        "03": F.col("appcode") != PARTNER_APPCODE,
        "04": F.col("product_company") != PARTNER_COMPANY,
        "05": ~F.col("transaction_type").isin(*MOVEMENT_TYPES),
        "06": ~F.col("causalcode").isin(*PARTNER_CAUSALS),
        BAD_AMOUNT_CODE: reason == BAD_AMOUNT,
    }
    codes = F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()])
    code = F.col("response_code")
    text = F.when(F.lit(False), F.lit(""))
    for value, meaning in (RESPONSE_TEXTS | {BAD_AMOUNT_CODE: BAD_AMOUNT_TEXT}).items():
        text = text.when(code == value, meaning)
    return routed.withColumn("response_code", F.explode(F.array_compact(codes))).withColumn("response_text", text)
