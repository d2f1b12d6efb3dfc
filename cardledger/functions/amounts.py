"""Amounts: signed overpunch, implied decimals, signed points, partner units.

All arithmetic is exact decimal; text that is no number becomes NULL, which
the routing step turns into a reject instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sign characters of the overpunch code in digit order 0-9,
# first the positive ten, then the negative ten.
POSITIVE_SIGNS = "àABCDEFGHI"
NEGATIVE_SIGNS = "èJKLMNOPQR"


def _last(raw: Column) -> Column:
    return F.substring(raw, -1, 1)


def _in_code(raw: Column, signs: str) -> Column:
    last = _last(raw)
    return (last != "") & F.contains(F.lit(signs), last)


def overpunch_sign(raw: Column) -> Column:
    """``+`` or ``-``; NULL for a last character outside the code."""
    return F.when(_in_code(raw, POSITIVE_SIGNS), "+").when(_in_code(raw, NEGATIVE_SIGNS), "-")


def overpunch_digits(raw: Column) -> Column:
    """All digits as text, the last one decoded; NULL for a bad last character."""
    digit = F.translate(_last(raw), POSITIVE_SIGNS + NEGATIVE_SIGNS, "0123456789" * 2)
    decoded = F.concat(F.substring(raw, F.lit(1), F.length(raw) - 1), digit)
    return F.when(_in_code(raw, POSITIVE_SIGNS + NEGATIVE_SIGNS), decoded)


def _whole_points(raw: Column) -> Column:
    # The two implied decimals go, the decoded character among them.
    whole = F.ltrim(F.substring(raw, F.lit(1), F.length(raw) - 2), F.lit("0"))
    return F.coalesce(F.nullif(whole, F.lit("")), F.lit("0"))


def implied_points_text(raw: Column) -> Column:
    """Unsigned whole points as text: two implied decimals cut, zeros stripped, never empty."""
    return F.when(_in_code(raw, POSITIVE_SIGNS + NEGATIVE_SIGNS), _whole_points(raw))


def implied_points(raw: Column) -> Column:
    """Signed whole points; NULL for a malformed field, which is then rejected (Q19)."""
    return F.concat(overpunch_sign(raw), F.trim(_whole_points(raw))).try_cast("bigint")


def posted_amount(raw: Column) -> Column:
    """Unsigned posted amount with its two decimals kept (Q2)."""
    return (overpunch_digits(raw).try_cast("decimal(15,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(15,2)")


def signed_amount(sign: Column, value: Column) -> Column:
    """Sign and value text as an exact number; NULL when it is none (Q4)."""
    return F.concat(sign, value).try_cast("decimal(18,3)")


def partner_balance_points(virtual_credit: Column) -> Column:
    """A2: the partner sends virtual credit in thousandths."""
    return (virtual_credit / 1000).cast("decimal(28,6)")


def _partner_units(transaction_type: Column, value: Column, credit_divisor: int) -> Column:
    # Exact decimals, cut towards zero; a float would lose digits (Q5).
    number = value.try_cast("decimal(20,6)")
    credit = (number / credit_divisor).cast("decimal(26,9)")
    return F.when(transaction_type == "VC", credit.cast("bigint")).otherwise((number * 100).cast("bigint"))


def partner_value_units(transaction_type: Column, value: Column) -> Column:
    """Value in units for virtual credit, in hundredths for everything else."""
    return _partner_units(transaction_type, value, 1000)


def partner_transaction_units(transaction_type: Column, value: Column) -> Column:
    """Transaction value in hundredths for both kinds."""
    return _partner_units(transaction_type, value, 10)
