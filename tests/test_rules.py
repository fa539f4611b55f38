"""Every cleaning rule against a table of cases."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tidemart.functions import catalog, customers, dates, numbers, sales
from tidemart.functions.text import (
    WHITE_SPACE,
    fields_of,
    filled,
    or_not_available,
    recode,
    trimmed,
)

DAY = dt.date.fromisoformat


def check(spark, rule, cases):
    """Compare ``rule("x")`` over all cases in one job."""
    rows = [(number, given) for number, (given, _) in enumerate(cases)]
    got = dict(
        spark.createDataFrame(rows, "n int, x string").selectExpr("n", f"{rule} AS y").collect()
    )
    assert [got[n] for n in range(len(cases))] == [wanted for _, wanted in cases], cases


CASES = {
    "customer id": (
        numbers.digits_only("x"),
        [
            ("11000", 11000),
            ("ABC", None),
            ("", None),
            ("-5", None),
            ("1.0", None),
            ("²", None),
            ("12\n", None),
            ("99999999999999999999", None),
            (None, None),
        ],
    ),
    "customer key": (
        customers.customer_key("x"),
        [
            ("AW00011000", "AW00011000"),
            ("aw00011000", "AW00011000"),
            ("AW0001100", None),
            ("AX00011000", None),
            ("AW0001100X", None),
            ("AW000110000", None),
            ("", None),
        ],
    ),
    "marital status": (
        customers.marital_status("x"),
        [("m", "Married"), ("M", "Married"), ("S", "Single"), ("X", None), ("", None)],
    ),
    "gender letter": (
        customers.gender_of_letter("x"),
        [("f", "Female"), ("M", "Male"), ("Male", None), ("", None)],
    ),
    "dashed date": (
        dates.dashed_date("x"),
        [
            ("2025-10-06", DAY("2025-10-06")),
            ("2025-02-30", None),
            ("2025-1-5", None),
            ("2024-02-29", DAY("2024-02-29")),
            ("1971/10/06", None),
            ("9999-12-31", DAY("9999-12-31")),
            ("0000-01-01", None),
            ("1980-13-01", None),
            ("2025-10-06\n", None),
            ("", None),
        ],
    ),
    "birth key": (
        customers.customer_key_of_birth("x"),
        [
            ("NASAW00011000", "AW00011000"),
            ("nasaw00011000", "AW00011000"),
            ("AW00011000", None),
            ("NASAW0001100X", None),
            ("", None),
        ],
    ),
    "gender word": (
        customers.gender_of_word("x"),
        [("MALE", "Male"), ("female", "Female"), ("F", None), ("", None)],
    ),
    "location key": (
        customers.customer_key_of_location("x"),
        [
            ("AW-00011000", "AW00011000"),
            ("aw-00011000", "AW00011000"),
            ("AW00011000", None),
            ("AW-0001100-", None),
            ("", None),
        ],
    ),
    "country": (
        customers.country_name("x"),
        [
            ("US", "United States"),
            ("USA", "United States"),
            ("United States", "United States"),
            ("DE", "Germany"),
            ("Germany", "Germany"),
            ("France", "France"),
            ("Canada", "Canada"),
            ("Australia", "Australia"),
            ("United Kingdom", "United Kingdom"),
            ("us", None),
            ("Spain", None),
            ("", None),
        ],
    ),
    "category key": (
        catalog.category_key("x"),
        [("AC_BR", "AC_BR"), ("AC-BR", None), ("AC_BRX", None), ("A_CBR", None), ("", None)],
    ),
    "optional text": (filled("x"), [("a", "a"), ("", None), (None, None)]),
    "maintenance": (
        catalog.maintenance_flag("x"),
        [("Yes", "Yes"), ("No", "No"), ("yes", None), ("", None)],
    ),
    "number": (
        numbers.number("x"),
        [
            ("12", 12.0),
            ("+1.5", 1.5),
            (".5", 0.5),
            ("5.", 5.0),
            ("-3e2", -300.0),
            ("1d", None),
            ("1_0", None),
            ("nan", None),
            ("inf", None),
            ("1e999", None),
            ("-1e999", None),
            ("", None),
        ],
    ),
    "product id": (
        catalog.product_id("x"),
        [("210", "210"), ("1234", "N/A"), ("abc", "abc"), ("", "N/A")],
    ),
    "category of composite": (
        catalog.category_of_composite("x"),
        [("CO-RF-FR-R92B-58", "CO_RF"), ("CO-RF", "CO_RF"), ("A-", "A_"), ("", "N/A")],
    ),
    "product key of composite": (
        catalog.product_key_of_composite("x"),
        [("CO-RF-FR-R92B-58", "FR-R92B-58"), ("CO-RF", ""), ("CO-RF-", ""), ("", "N/A")],
    ),
    "product name": (catalog.product_name("x"), [("Pedal", "Pedal"), ("", "N/A")]),
    "product cost": (
        catalog.product_cost("x"),
        [("12", 12.0), ("", 0.0), ("-3", 0.0), ("abc", 0.0), ("0", 0.0), ("nan", 0.0)],
    ),
    "product line": (
        catalog.product_line("x"),
        [
            ("m", "Mountain"),
            ("R", "Road"),
            ("S", "Other Sales"),
            ("T", "Touring"),
            ("Z", "N/A"),
            ("", "N/A"),
        ],
    ),
    "order number": (
        sales.order_number("x"),
        [
            ("SO43697", "SO43697"),
            ("SOabcde", "SOabcde"),
            ("so43697", "N/A"),
            ("SO-4369", "N/A"),
            ("SO4369", "N/A"),
            ("", "N/A"),
        ],
    ),
    "sold product key": (
        sales.sold_product_key("x"),
        [("BK-R93R-62", "BK-R93R-62"), ("BK-", "BK-"), ("BKR93R", "N/A"), ("BK", "N/A"), ("", "N/A")],
    ),
    "buyer id": (
        sales.buyer_id("x"),
        [("21768", 21768), ("123", None), ("", None), ("ABCDE", None), ("12.34", None)],
    ),
    "compact date": (
        dates.compact_date("x"),
        [
            ("20101229", DAY("2010-12-29")),
            ("20110110", DAY("2011-01-10")),
            ("", None),
            ("32154", None),
            ("20130231", None),
            ("20131399", None),
            ("00000101", None),
            ("2013-7-1", None),
        ],
    ),
    "compact date issue": (
        dates.compact_date_issue("x", dates.compact_date("x")),
        [
            ("20101229", None),
            ("", "missing"),
            ("32154", "bad_length"),
            ("20130231", "bad_date"),
            ("2013-7-1", "bad_date"),
        ],
    ),
    "field count": (f"size({fields_of('x')})", [("a,b,c", 3), ("a,b,", 3), (",", 2), ("", 1), ("a", 1)]),
}


@pytest.mark.parametrize("name", CASES)
def test_rule(spark, name):
    check(spark, *CASES[name])


def test_trim_strips_what_python_strips(spark):
    texts = [f"{space}a{space}b{space}" for space in WHITE_SPACE]
    texts += ["", " ", " ", "a", " a", "é ", "​a​", "﻿a", "  \t x 　"]
    cases = [(text, text.strip()) for text in texts]
    check(spark, trimmed("x", "x RLIKE r'\\A[ -~]*\\z'"), cases)
    check(spark, trimmed("x", "false"), cases)
    assert all(space.isspace() for space in WHITE_SPACE)
    assert {chr(code) for code in range(0x10000) if chr(code).isspace()} == set(WHITE_SPACE)


def test_names(spark):
    rows = [("Jon", "Yang"), ("Jon", ""), ("", "Yang"), ("", "")]
    got = spark.createDataFrame(rows, "a string, b string").selectExpr(
        customers.full_name("a", "b") + " AS name"
    )
    assert [row.name for row in got.collect()] == ["Jon Yang", "Jon", "Yang", None]


def test_age(spark):
    cases = [
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("1990-06-15", "2026-06-15", 36),
        ("1990-06-15", "2026-06-14", 35),
        ("1990-06-15", "2026-05-30", 35),
        (None, "2026-01-01", None),
    ]
    rows = [(birth and DAY(birth), DAY(as_of), age) for birth, as_of, age in cases]
    got = spark.createDataFrame(rows, "b date, a date, age int").selectExpr(
        "age", dates.completed_years("b", "a") + " AS years"
    )
    assert all(row.age == row.years for row in got.collect())


def test_amounts(spark):
    cases = [
        ((100, 2, 50), (100, 2, 50)),
        ((100, 2, None), (100, 2, 50)),
        ((None, 2, 50), (100, 2, 50)),
        ((100, 0, 50), (50, 1, 50)),
        ((101, 2, 50), (100, 2, 50)),
        ((-5, 2, 50), (100, 2, 50)),
        ((100, 2, -50), (100, 2, 50)),
        ((None, None, None), (0, 1, 0)),
        ((100.004, 2, 50), (100.004, 2, 50)),
    ]
    for given, wanted in cases:
        row = [None if value is None else float(value) for value in given]
        df = spark.createDataFrame([row], "amount double, quantity double, price double")
        got = sales.reconcile_amounts(df, "amount", "quantity", "price").first()
        assert (got.amount, got.quantity, got.price) == wanted, given


def test_cents_round_as_python_does(spark):
    random.seed(5)
    values = [2.675, 0.125, 0.135, 4700.525, 1.005, 0.0, -2.675, -0.001, 1e15 + 0.3, 1e22, 123.0]
    values += [random.uniform(0, 10_000) for _ in range(2_000)]
    values += [random.randrange(10**7) / random.choice([8, 40, 200, 1000]) for _ in range(4_000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").selectExpr(
        "v", numbers.cents("v") + " AS c"
    )
    assert [row.c for row in got.collect()] == [round(value, 2) for value in values]


def test_gender_country_and_default(spark):
    got = spark.sql(
        f"""SELECT {customers.preferred_gender("'Male'", "'Female'")} AS a,
            {customers.preferred_gender("NULL", "'Female'")} AS b,
            {customers.preferred_gender("NULL", "NULL")} AS c,
            {customers.country_of_location("NULL", "NULL")} AS d,
            {customers.country_of_location("'k'", "NULL")} AS e,
            {customers.country_of_location("'k'", "'France'")} AS f,
            {or_not_available("'x'", "false")} AS g,
            {or_not_available("NULL", "true")} AS h,
            {recode("'it''s'", {"it's": "yes"})} AS i"""
    ).first()
    assert tuple(got) == (
        "Male", "Female", None, None, "Unknown", "France", "N/A", None, "yes",
    )


def test_months_and_date_text(spark):
    wanted = [dt.date(2000, month, 1).strftime("%B") for month in range(1, 13)]
    got = spark.range(1, 13).selectExpr(dates.month_label("CAST(id AS INT)") + " AS m")
    assert [row.m for row in got.collect()] == wanted
    cases = [
        (DAY("2011-01-05"), None, "2011-01-05"),
        (None, "missing", "N/A"),
        (None, "bad_date", "N/A"),
        (None, "bad_length", None),
    ]
    df = spark.createDataFrame([case[:2] for case in cases], "d date, i string")
    got = df.selectExpr(dates.date_text("d", "i") + " AS t", dates.date_text("d") + " AS u")
    assert [row.t for row in got.collect()] == [case[2] for case in cases]
    assert [row.u for row in got.collect()] == ["2011-01-05", "N/A", "N/A", "N/A"]
