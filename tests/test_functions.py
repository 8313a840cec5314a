"""Hand-written edge rows of the column functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintagemart.functions import cleaning, dates, loans


def one(spark, column, value=None, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(column.alias("y")).first()[0]


@pytest.mark.parametrize(
    "text, age, band",
    [
        ("39_", 39, "Adult"),
        ("-500", 500, "Senior"),
        ("24", 24, "Youth"),
        ("25", 25, "Adult"),
        ("45", 45, "Middle-aged"),
        ("65", 65, "Senior"),
        ("", None, "Senior"),
        (None, None, "Senior"),
        ("99999999999", None, "Senior"),
    ],
)
def test_age(spark, text, age, band):
    cleaned = cleaning.digits_to_int(F.col("x"))
    assert one(spark, cleaned, text) == age
    assert one(spark, cleaning.age_band(cleaned), text) == band


@pytest.mark.parametrize(
    "text, age, band", [("-500", None, None), ("39_", 39, "Adult"), (None, None, None)]
)
def test_strict_age(spark, text, age, band):
    cleaned = cleaning.signed_age(F.col("x"))
    assert one(spark, cleaned, text) == age
    assert one(spark, cleaning.age_band(cleaned, None), text) == band


@pytest.mark.parametrize(
    "text, number",
    [("1234.5_", 1234.5), ("--", None), ("", None), ("-333", -333.0), (None, None), ("1.2.3", None)],
)
def test_clean_number(spark, text, number):
    assert one(spark, cleaning.clean_number(F.col("x")), text) == number


@pytest.mark.parametrize(
    "text, months",
    [
        ("31 Years and 0 Months", 372),
        ("1 Year and 3 Months", None),
        ("4 Years", None),
        ("NA", None),
        (None, None),
    ],
)
def test_duration(spark, text, months):
    assert one(spark, cleaning.duration_months(F.col("x")), text) == months


@pytest.mark.parametrize(
    "text, kept", [("Low_spent", "Low_spent"), ("!@9#%8", "Unknown"), (None, "Unknown")]
)
def test_whitelist(spark, text, kept):
    assert one(spark, cleaning.keep_matching(F.col("x")), text) == kept


@pytest.mark.parametrize(
    "text, items, strict",
    [
        ("A Loan", 1, 1),
        ("A Loan and B Loan", 2, 2),
        ("A, B, and C", 4, 3),
        ("A , B", 2, 2),
        (None, 0, 0),
    ],
)
def test_list_items(spark, text, items, strict):
    assert one(spark, cleaning.count_list_items(F.col("x")), text) == items
    assert one(spark, cleaning.count_list_items(F.col("x"), strict=True), text) == strict


def test_encodings(spark):
    grade = cleaning.encode(F.col("x"), cleaning.CREDIT_MIX_SCORE)
    assert [one(spark, grade, v) for v in ("Bad", "Standard", "Good", "_", None)] == [
        0, 1, 2, None, None,
    ]
    flag = cleaning.equals_flag(F.col("x"), "Married")
    assert [one(spark, flag, v) for v in ("Married", "Single", None)] == [1, 0, 0]
    assert one(spark, cleaning.clean_label(F.col("x")), " \tActive\n") == "active"


@pytest.mark.parametrize("value, clipped", [(1.0, 2.0), (3.0, 3.0), (9.0, 5.0), (None, None)])
def test_clip(spark, value, clipped):
    assert one(spark, cleaning.clip(F.col("x"), 2.0, 5.0), value, "double") == clipped


def test_numbers_or_zero(spark):
    as_number = cleaning.number_in_text(F.col("x"))
    texts = ("1.5", " -.5e2\n", "junk", None, "5d", "7f", "NaN", "Infinity", "")
    assert [one(spark, as_number, v) for v in texts] == [1.5, -50.0, *[None] * 7]
    ratio = cleaning.divide_or_zero(F.lit(3.0), F.col("x"))
    assert [one(spark, ratio, v, "double") for v in (2.0, 0.0, None)] == [1.5, 0.0, 0.0]


@pytest.mark.parametrize(
    "due, overdue, missed, first, dpd",
    [
        (100.0, 250.0, 3, date(2023, 12, 1), 91),
        (100.0, 200.0, 2, date(2024, 1, 1), 60),
        (0.0, 50.0, 0, None, None),
        (100.0, 0.0, 0, None, 0),
        (None, 50.0, 0, None, None),
        (100.0, None, None, None, 0),
    ],
)
def test_arrears(spark, due, overdue, missed, first, dpd):
    df = spark.createDataFrame(
        [(due, overdue, date(2024, 3, 1))], "due float, overdue float, day date"
    )
    n = loans.installments_missed(F.col("overdue"), F.col("due"))
    since = loans.first_missed_date(F.col("day"), n)
    late = loans.days_past_due(F.col("day"), since, F.col("overdue"))
    assert tuple(df.select(n, since, late).first()) == (missed, first, dpd)


@pytest.mark.parametrize("dpd, label", [(30, 1), (29, 0), (None, 0)])
def test_label(spark, dpd, label):
    assert one(spark, loans.default_flag(F.col("x"), 30), dpd, "int") == label
    assert loans.label_definition(30, 6) == "30dpd_6mob"


def test_payment(spark):
    zero_rate = loans.annuity_payment(F.lit(1200.0), F.lit(0.0), F.lit(12))
    assert one(spark, zero_rate) is None
    payment = one(spark, loans.annuity_payment(F.lit(1200.0), F.lit(0.12), F.lit(12)))
    assert payment == pytest.approx(106.61854641401)


@pytest.mark.parametrize(
    "customer, loan",
    [("USER_000007", "LOAN_000007"), ("X", "LOAN_000000"), (None, "LOAN_000000")],
)
def test_loan_id(spark, customer, loan):
    assert one(spark, loans.loan_id_from_customer(F.col("x")), customer) == loan


def test_risk_score(spark):
    worst = loans.rule_risk_score(F.lit(0.5), F.lit(500), F.lit(0.9), F.lit(1.0))
    best = loans.rule_risk_score(F.lit(0.4), F.lit(600), F.lit(0.7), F.lit(2.0))
    unknown = loans.rule_risk_score(*[F.lit(None).cast("double")] * 4)
    assert one(spark, worst) == pytest.approx(0.13)
    assert one(spark, best) == one(spark, unknown) == 0.05


def test_month_spine(spark):
    months = [r[0] for r in dates.month_spine(spark, "2023-11-15", "2024-02-01").collect()]
    assert months == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    assert dates.month_spine(spark, "2024-02-01", "2024-01-01").count() == 0


def test_training_windows():
    w = dates.TrainingWindows.before("2024-09-01", 12, 2)
    assert (w.train_test_start, w.train_test_end) == (date(2023, 7, 1), date(2024, 6, 30))
    assert (w.oot_start, w.oot_end) == (date(2024, 7, 1), date(2024, 8, 31))
    assert dates.shift_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
