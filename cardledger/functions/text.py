"""Text helpers: trimming, date encodings, names, e-mail repair, keys, output lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n\x0b\x0c"


def stripped(text: Column) -> Column:
    """Blanks, tabs and line ends off both sides.

    Padding is almost always blanks, which the plain trim removes far faster
    than a trim by character set; the set then sees the short rest.
    """
    return F.btrim(F.trim(text), F.lit(BLANKS))


def century_date(text: Column) -> Column:
    """``CYYMMDD`` to ``yyyyMMdd``; any other century digit, or none, gives a text starting ``ER`` (Q18)."""
    given = F.coalesce(text, F.lit(""))
    century = F.left(given, F.lit(1))
    prefix = F.when(century == "0", "19").when(century == "1", "20").when(century == "2", "21").otherwise("ER")
    return F.concat(prefix, F.substring(given, 2, 6))


def day_first_date(text: Column) -> Column:
    """``DDMMYYYY`` to ``yyyyMMdd``."""
    return F.concat(F.substring(text, 5, 4), F.substring(text, 3, 2), F.substring(text, 1, 2))


def typed_date(text: Column) -> Column:
    """``yyyyMMdd`` text as a date, NULL when it is none."""
    return F.try_to_date(text, "yyyyMMdd")


def date_part(timestamp_text: Column) -> Column:
    """The day of a ``yyyyMMddHHmmss`` text."""
    return F.substring(timestamp_text, 1, 8)


def given_name(full_name: Column) -> Column:
    """The part before ``*``; a name without ``*`` stays whole."""
    parts = F.split(full_name, r"\*")
    return F.when(F.contains(full_name, F.lit("*")), stripped(F.get(parts, F.lit(0)))).otherwise(full_name)


def surname(full_name: Column) -> Column:
    """The part between the first and the second ``*``, else empty."""
    parts = F.split(full_name, r"\*")
    return F.when(F.contains(full_name, F.lit("*")), stripped(F.get(parts, F.lit(1)))).otherwise(F.lit(""))


def repaired_email(text: Column) -> Column:
    """``§`` stands for ``@``; after Latin-1 decoding its two-byte form reads ``Â§``."""
    return F.replace(F.replace(text, F.lit("Â§"), F.lit("@")), F.lit("§"), F.lit("@"))


def transaction_key(
    appcode: Column, transaction_id: Column, transaction_date: Column, file_timestamp: Column | None = None
) -> Column:
    """Id that is unique over all feeds; without the file timestamp it names the movement in any file."""
    parts = [appcode, transaction_id, F.lit("_"), transaction_date]
    if file_timestamp is not None:
        parts += [F.lit("_"), file_timestamp]
    return F.concat(*parts)


def action_id(appcode: Column, run_ts: Column, product_company: Column, customer_number: Column) -> Column:
    """Two accounts of one customer share it within a run (Q22)."""
    return F.concat(appcode, run_ts, product_company, customer_number)


def joined_fields(columns: Sequence[Column], delimiter: str = ";") -> Column:
    """Fields as one delimited text, NULL as empty and values untouched."""
    return F.concat_ws(delimiter, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def document_line(columns: Sequence[Column], delimiter: str = ";") -> Column:
    """K7: one output line; a delimiter inside a value becomes a blank (Q17)."""
    return joined_fields([F.replace(c.cast("string"), F.lit(delimiter), F.lit(" ")) for c in columns], delimiter)
