"""Scalar functions, value by value."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardledger import functions as cf
from cardledger.functions.amounts import NEGATIVE_SIGNS, POSITIVE_SIGNS
from cardledger.functions.currency import CURRENCIES, with_currency


def column(spark, values, *exprs, type_="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    columns = [make(F.col("x")).alias(f"c{n}") for n, make in enumerate(exprs)]
    return [tuple(r)[1:] for r in frame.select("i", *columns).orderBy("i").collect()]


def test_all_twenty_sign_characters_and_bad_ones(spark):
    raws = [f"0000000001234{c}" for c in POSITIVE_SIGNS + NEGATIVE_SIGNS]
    rows = column(spark, raws, cf.overpunch_sign, cf.overpunch_digits)
    assert rows == [("+" if i < 10 else "-", f"0000000001234{i % 10}") for i in range(20)]
    bad = ["123?", "1234", "", None, "12a", "à1"]
    assert column(spark, bad, cf.overpunch_sign, cf.overpunch_digits, cf.implied_points) == [(None,) * 3] * 6


@pytest.mark.parametrize(
    ("raw", "text", "points"),
    [
        ("00000000001234A", "123", 123),
        ("00000000001234J", "123", -123),
        ("00000000000000à", "0", 0),
        ("00000000000000è", "0", 0),
        ("00000000000009I", "0", 0),
        ("A", "0", 0),
        ("99999999999999R", "9999999999999", -9999999999999),
    ],
)
def test_implied_points(spark, raw, text, points):
    assert column(spark, [raw], cf.implied_points_text, cf.implied_points) == [(text, points)]


def test_letters_between_the_digits_are_no_number(spark):
    assert column(spark, ["00x123A"], cf.implied_points, cf.posted_amount) == [(None, None)]


def test_posted_amount_keeps_its_decimals(spark):
    assert column(spark, ["00000000012345F", "00000000000000à"], cf.posted_amount) == [
        (Decimal("1234.56"),),
        (Decimal("0.00"),),
    ]


def test_century_dates(spark):
    values = ["0991231", "1240229", "2000101", "3240101", "", None, "1230229", "12"]
    assert column(spark, values, cf.century_date, lambda x: cf.typed_date(cf.century_date(x))) == [
        ("19991231", datetime.date(1999, 12, 31)),
        ("20240229", datetime.date(2024, 2, 29)),
        ("21000101", datetime.date(2100, 1, 1)),
        ("ER240101", None),
        ("ER", None),
        ("ER", None),
        ("20230229", None),
        ("202", None),
    ]
    assert column(spark, ["31012024"], cf.day_first_date) == [("20240131",)]


def test_every_currency_and_unknown_ones(spark):
    pairs = list(CURRENCIES.items())
    assert len(pairs) == len(dict(pairs)) == 173
    frame = spark.createDataFrame([(n,) for n, _ in pairs] + [("000",), (None,)], "n string")
    found = {r["n"]: r["currency_code"] for r in with_currency(frame, "n").collect()}
    assert found == {**dict(pairs), "000": "EUR", None: "EUR"}


def test_names(spark):
    values = ["ANNA * ROSSI ", "ANNA", "*ROSSI", "A*B*C", "ANNA*", "", None]
    assert column(spark, values, cf.given_name, cf.surname) == [
        ("ANNA", "ROSSI"),
        ("ANNA", ""),
        ("", "ROSSI"),
        ("A", "B"),
        ("ANNA", ""),
        ("", ""),
        (None, ""),
    ]


def test_email_in_both_encodings(spark):
    assert column(spark, ["a§b.it", "aÂ§b.it", "a@b.it"], cf.repaired_email) == [("a@b.it",)] * 3


def test_stripping_takes_tabs_and_line_ends(spark):
    assert column(spark, [" \t a b\t \r\n", "   ", "\tx"], cf.stripped) == [("a b",), ("",), ("x",)]


def test_a_key_with_a_missing_part_is_missing(spark):
    def key(x):
        return cf.transaction_key(F.lit("CHP"), x, F.lit("20240101"), F.lit("T"))

    assert column(spark, ["7", None], key) == [("CHP7_20240101_T",), (None,)]


@pytest.mark.parametrize(
    ("kind", "value", "unit", "hundredths"),
    [
        ("VC", "123456789", 123456, 12345678),
        ("VC", "999", 0, 99),
        ("VC", "-1999", -1, -199),
        ("E", "12", 1200, 1200),
        ("E", "1.999", 199, 199),
        ("ZZ", "5", 500, 500),
        (None, "5", 500, 500),
        ("E", "99999999999", 9999999999900, 9999999999900),
        ("VC", "abc", None, None),
        ("E", None, None, None),
    ],
)
def test_partner_units_are_exact_and_cut(spark, kind, value, unit, hundredths):
    def units(function):
        return lambda x: function(F.lit(kind).cast("string"), x)

    exprs = units(cf.partner_value_units), units(cf.partner_transaction_units)
    assert column(spark, [value], *exprs) == [(unit, hundredths)]


def test_signed_amounts(spark):
    amount = cf.signed_amount(F.col("s"), F.col("v"))
    frame = spark.createDataFrame(
        [("+", "5"), ("-", "5.5"), ("+", "ERRO"), (None, "5"), ("", "7")], "s string, v string"
    )
    assert [r[0] for r in frame.select(amount).collect()] == [
        Decimal("5.000"),
        Decimal("-5.500"),
        None,
        None,
        Decimal("7.000"),
    ]


def test_lines_escape_delimiters_and_print_nothing_for_null(spark):
    frame = spark.createDataFrame([("a;b", None, 3)], "a string, b string, c int")
    columns = [F.col(c) for c in frame.columns]
    assert frame.select(cf.document_line(columns), cf.joined_fields(columns)).first()[:] == ("a b;;3", "a;b;;3")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(10**13) + 1, 10**13 - 1), min_size=1, max_size=30))
def test_overpunch_round_trip(spark, numbers):
    def encoded(n):
        digits = f"{abs(n) * 100:015d}"
        return digits[:-1] + (NEGATIVE_SIGNS if n < 0 else POSITIVE_SIGNS)[int(digits[-1])]

    assert column(spark, [encoded(n) for n in numbers], cf.implied_points) == [(n,) for n in numbers]
