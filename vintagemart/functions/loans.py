"""Loan arithmetic: arrears, labels, payments, rule scores, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base rate and weights of the additive default score.
BASE_RISK = 0.05
RISK_WEIGHTS = {
    "debt_to_income": 0.02,
    "credit_score": 0.03,
    "utilization_rate": 0.02,
    "employment_length_years": 0.01,
}
RISK_LIMITS = {
    "debt_to_income": 0.4,
    "credit_score": 600,
    "utilization_rate": 0.7,
    "employment_length_years": 2,
}


def installments_missed(overdue: Column, due: Column) -> Column:
    """Whole installments overdue; 0 where nothing (or null) is due.

    Null overdue with a positive due stays null.
    """
    return F.when(due != 0, F.ceil(F.try_divide(overdue, due))).otherwise(F.lit(0)).cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, first_missed: Column, overdue: Column) -> Column:
    """Days since the first missed installment; 0 without overdue amount.

    Overdue without a first missed date (nothing was due) is null.
    """
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def default_flag(dpd: Column, threshold: int) -> Column:
    return F.when(dpd >= threshold, F.lit(1)).otherwise(F.lit(0))


def default_flag_from_mob(dpd: Column, mob: Column, dpd_min: int, mob_min: int) -> Column:
    return F.when((dpd >= dpd_min) & (mob >= mob_min), F.lit(1)).otherwise(F.lit(0))


def label_definition(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"


def annuity_payment(principal: Column, yearly_rate: Column, months: Column) -> Column:
    """Level monthly payment; null for a zero rate, where the formula is 0/0."""
    rate = yearly_rate / F.lit(12)
    growth = F.pow(F.lit(1.0) + rate, months)
    return F.try_divide(principal * rate * growth, growth - F.lit(1.0))


def loan_age_days(snapshot: Column, origination: Column) -> Column:
    return F.datediff(snapshot.cast("date"), origination.cast("date"))


def rule_risk_score(
    debt_to_income: Column,
    credit_score: Column,
    utilization: Column,
    employment_years: Column,
) -> Column:
    """Base rate plus one weight per breached limit; null breaches nothing."""
    breaches = {
        "debt_to_income": debt_to_income > RISK_LIMITS["debt_to_income"],
        "credit_score": credit_score < RISK_LIMITS["credit_score"],
        "utilization_rate": utilization > RISK_LIMITS["utilization_rate"],
        "employment_length_years": employment_years < RISK_LIMITS["employment_length_years"],
    }
    score = F.lit(BASE_RISK)
    for name, breached in breaches.items():
        score = score + F.when(breached, F.lit(RISK_WEIGHTS[name])).otherwise(F.lit(0.0))
    return score


def loan_id_from_customer(customer_id: Column) -> Column:
    """``USER_000007`` -> ``LOAN_000007``; ids without ``_`` -> ``LOAN_000000``."""
    number = F.when(
        customer_id.contains("_"), F.split_part(customer_id, F.lit("_"), F.lit(2))
    ).otherwise(F.lit("000000"))
    return F.concat(F.lit("LOAN_"), number)
