"""Attribute-per-line feeds to one row per account; the last line of a file wins.

Each pivot is one aggregate, so it shuffles once.  Every task first reduces its
own lines to one row per account, which keeps an account with a third of all
lines as cheap as any other.  Lines outside the keep rules are filtered before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.functions import century_date, given_name, repaired_email, stripped, surname
from cardledger.operators.decode import MAINFRAME_APPCODE
from cardledger.schemas import ENROLMENT_ALIASES, STAGED_ENROLMENT, STAGED_MAINTENANCE, conform

# Fixed values of the enrolment and maintenance rules.
CARD_REQUEST = "REQCARD"
PROGRAMME_ADD = "LOYADD"
PROGRAMME_REMOVE = "LOYDEL"
ACCEPTED_RESULT = "P"
ACCOUNT_KEY = "A"
ACCOUNT_ALIAS = "X1142237"
PROGRAMME_ALIAS = "X11422FS"
PROGRAMME_STATUS_ALIAS = "X11422BI"
MAINTENANCE_COMPANY = "18200"
UNKNOWN_CUSTOMER = "customerNumberNA"

# Attribute code -> (column, needed maintenance type, width, trimmed after the cut).
MAINTENANCE_ALIASES = {
    "X11422C2": ("plastic_status", None, 2, False),
    "X11422PG": ("cup", "C", 15, True),
    "X1142289": ("livrea", "A", 3, True),
    "X1142278": ("dealer", "A", 25, False),
    "X1142234": ("convenzione", "A", 25, True),
}


def last_value(chosen: Column, value: Column, order: Column) -> Column:
    """Value of the last chosen line, NULL when there is none."""
    return F.max_by(F.when(chosen, value), F.when(chosen, order))


def _key_columns(lines: DataFrame, key: str) -> list[str]:
    return [key] + [c for c in ("input_filename",) if c in lines.columns]


# ---- enrolment ------------------------------------------------------------


def kept_enrolment_lines(details: DataFrame) -> DataFrame:
    """F7."""
    return details.filter(
        (F.col("function_id") == CARD_REQUEST)
        & (F.col("result") == ACCEPTED_RESULT)
        & F.col("alias_id").isin(list(ENROLMENT_ALIASES))
    )


def pivot_enrolment(details: DataFrame, order: str = "line_order") -> DataFrame:
    """One row per account and file with all attributes, missing ones empty."""
    kept = kept_enrolment_lines(details)
    value = F.coalesce("value", F.lit(""))
    keys = _key_columns(kept, "key_of_function")
    wide = kept.groupBy(*keys).agg(
        *[
            F.coalesce(last_value(F.col("alias_id") == alias, value, F.col(order)), F.lit("")).alias(name)
            for alias, name in ENROLMENT_ALIASES.items()
        ],
        F.max_by("issuer_batch_id", order).alias("issuer_batch_id"),
    )
    full_name = F.col("full_name")
    return (
        wide.withColumn("customer_name", given_name(full_name))
        .withColumn("customer_surname", surname(full_name))
        .withColumn("date_birth", century_date(F.col("date_birth")))
        .withColumn("email", repaired_email(F.col("email")))
        .drop("full_name")
    )


def staged_enrolment(pivoted: DataFrame, run_ts: str) -> DataFrame:
    """Pivoted accounts as the 30 columns of the staged table; new accounts start active and without status.

    Needs ``input_filename``, ``input_filename_timestamp`` and ``internallog_ts``.
    """
    fixed = {
        "appcode": F.lit(MAINFRAME_APPCODE),
        "issuer_id": F.lit(""),
        "is_customer_number_active": F.lit(True),
        "is_account_number_active": F.lit(True),
        "customer_status": F.lit(""),
        "account_status": F.lit(""),
        "elaboration_ts": F.lit(run_ts),
    }
    return conform(pivoted.withColumns(fixed), STAGED_ENROLMENT)


def _programme_lines(details: DataFrame) -> DataFrame:
    return details.filter(
        F.col("function_id").isin(PROGRAMME_ADD, PROGRAMME_REMOVE)
        & (F.col("result") == ACCEPTED_RESULT)
        & (F.col("key_type") == ACCOUNT_KEY)
    )


def programme_events(details: DataFrame, order: str = "line_order") -> DataFrame:
    """Programme additions and removals per account; removals only name the account."""
    lines = _programme_lines(details)
    same_account = (F.col("alias_id") == ACCOUNT_ALIAS) & (F.col("key_of_function") == F.col("value"))
    programme_fields = (F.col("function_id") == PROGRAMME_ADD) & F.col("alias_id").isin(
        PROGRAMME_ALIAS, PROGRAMME_STATUS_ALIAS
    )
    kept = lines.filter(same_account | programme_fields)
    value = F.coalesce("value", F.lit(""))
    targets = {
        ACCOUNT_ALIAS: "account_number",
        PROGRAMME_ALIAS: "loyalty_program_cod",
        PROGRAMME_STATUS_ALIAS: "loyalty_program_status",
    }
    return kept.groupBy("function_id", *_key_columns(kept, "key_of_function")).agg(
        *[
            F.coalesce(last_value(F.col("alias_id") == alias, value, F.col(order)), F.lit("")).alias(name)
            for alias, name in targets.items()
        ]
    )


def programme_errors(details: DataFrame) -> DataFrame:
    """Account lines that do not repeat their key."""
    return _programme_lines(details).filter(
        (F.col("alias_id") == ACCOUNT_ALIAS) & ~F.col("key_of_function").eqNullSafe(F.col("value"))
    )


# ---- maintenance ----------------------------------------------------------


def _maintenance_rule(alias: str) -> Column:
    needed = MAINTENANCE_ALIASES[alias][1]
    rule = F.col("alias_id") == alias
    return rule if needed is None else rule & (F.col("maint_type") == needed)


def kept_maintenance_lines(details: DataFrame) -> DataFrame:
    """accounts without any such line disappear."""
    keep = F.lit(False)
    for alias in MAINTENANCE_ALIASES:
        keep = keep | _maintenance_rule(alias)
    return details.filter(keep)


def wrong_company_lines(details: DataFrame) -> DataFrame:
    """lines of another product company; they are counted, not dropped."""
    return details.filter(F.col("key_company") != MAINTENANCE_COMPANY)


def pivot_maintenance(details: DataFrame, order: str = "line_order") -> DataFrame:
    """One row per account and file with old and new value of every attribute.

    Old and new come from the same line, so one aggregate over pairs replaces
    two pivots and their matching.
    """
    kept = kept_maintenance_lines(details)

    def pair(width: int, trimmed: bool) -> Column:
        sides = []
        for side in ("old", "new"):
            piece = F.substring(F.coalesce(f"{side}_value", F.lit("")), 1, width)
            sides.append((stripped(piece) if trimmed else piece).alias(side))
        return F.struct(*sides)

    keys = _key_columns(kept, "key_id")
    pairs = kept.groupBy(*keys).agg(
        *[
            last_value(_maintenance_rule(alias), pair(width, trimmed), F.col(order)).alias(f"_{name}")
            for alias, (name, _, width, trimmed) in MAINTENANCE_ALIASES.items()
        ]
    )
    return pairs.select(
        *keys,
        *[
            F.coalesce(F.col(f"_{name}.{side}"), F.lit("")).alias(f"{name}_{side}")
            for name, *_ in MAINTENANCE_ALIASES.values()
            for side in ("old", "new")
        ],
    )


def staged_maintenance(pivoted: DataFrame, run_ts: str) -> DataFrame:
    """Pivoted accounts as the 21 columns of the staged table.

    The status falls back to an attribute that is never captured, so it stays
    empty (Q12).  Needs ``input_filename`` and ``input_filename_timestamp``.
    """
    fixed = {
        "appcode": F.lit(MAINFRAME_APPCODE),
        "product_company": F.lit(MAINTENANCE_COMPANY),
        "keytype": F.lit(ACCOUNT_KEY),
        "customer_number": F.lit(UNKNOWN_CUSTOMER),
        "account_number": F.col("key_id"),
        "customer_status": F.lit(""),
        "account_status": F.lit(""),
        "elaboration_ts": F.lit(run_ts),
        "internallog_ts": F.col("input_filename_timestamp"),
    }
    return conform(pivoted.withColumns(fixed), STAGED_MAINTENANCE)
