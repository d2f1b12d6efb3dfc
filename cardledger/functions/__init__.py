from cardledger.functions.amounts import (
    implied_points,
    implied_points_text,
    overpunch_digits,
    overpunch_sign,
    partner_balance_points,
    partner_transaction_units,
    partner_value_units,
    posted_amount,
    signed_amount,
)
from cardledger.functions.currency import currency_table, with_currency
from cardledger.functions.text import (
    action_id,
    century_date,
    date_part,
    day_first_date,
    document_line,
    given_name,
    joined_fields,
    repaired_email,
    stripped,
    surname,
    transaction_key,
    typed_date,
)

__all__ = [
    "action_id",
    "century_date",
    "currency_table",
    "date_part",
    "day_first_date",
    "document_line",
    "given_name",
    "implied_points",
    "implied_points_text",
    "joined_fields",
    "overpunch_digits",
    "overpunch_sign",
    "partner_balance_points",
    "partner_transaction_units",
    "partner_value_units",
    "posted_amount",
    "repaired_email",
    "signed_amount",
    "stripped",
    "surname",
    "transaction_key",
    "typed_date",
    "with_currency",
]
