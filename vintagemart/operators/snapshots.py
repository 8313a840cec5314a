"""Snapshot extraction, loan enrichment, labels and silver cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemart import schemas
from vintagemart.functions import cleaning, loans
from vintagemart.functions.dates import TrainingWindows, as_date
from vintagemart.operators.columns import enforce_schema, fill_numeric_nulls, zero_infinite


def snapshot_extract(
    df: DataFrame, snapshot: date | str, date_col: str = "snapshot_date"
) -> DataFrame:
    """One snapshot of the table; a table without the date column is taken whole."""
    if date_col not in df.columns:
        return df
    return df.where(F.col(date_col) == F.lit(as_date(snapshot)))


def snapshot_range(
    df: DataFrame,
    first: date | str | None = None,
    last: date | str | None = None,
    before: date | str | None = None,
    date_col: str = "snapshot_date",
) -> DataFrame:
    """Closed range ``[first, last]`` and/or the half-open cut-off ``< before``."""
    if first is not None:
        df = df.where(F.col(date_col) >= F.lit(as_date(first)))
    if last is not None:
        df = df.where(F.col(date_col) <= F.lit(as_date(last)))
    if before is not None:
        df = df.where(F.col(date_col) < F.lit(as_date(before)))
    return df


def tag_windows(
    df: DataFrame, windows: TrainingWindows, date_col: str = "snapshot_date"
) -> DataFrame:
    """Keep rows of the training windows and tag them ``train_test`` or ``oot``."""
    day = F.col(date_col)
    split = F.when(
        day.between(F.lit(windows.train_test_start), F.lit(windows.train_test_end)), "train_test"
    ).when(day.between(F.lit(windows.oot_start), F.lit(windows.oot_end)), "oot")
    inside = day.between(F.lit(windows.train_test_start), F.lit(windows.oot_end))
    return df.where(inside).withColumn("split", split)


# --- lending schema -------------------------------------------------------


def loan_arrears(df: DataFrame, guard_zero_due: bool = True) -> DataFrame:
    """Months on book, installments missed, first missed date, days past due.

    ``guard_zero_due=False`` is the older rule: a quotient that does not exist
    is null and then every numeric null of the frame, not only this one,
    becomes 0.
    """
    out = df.withColumn("mob", F.col("installment_num").cast("int"))
    overdue, due = F.col("overdue_amt"), F.col("due_amt")
    if guard_zero_due:
        out = out.withColumn("installments_missed", loans.installments_missed(overdue, due))
    else:
        out = fill_numeric_nulls(
            out.withColumn(
                "installments_missed", F.ceil(F.try_divide(overdue, due)).cast("int")
            )
        )
    snapshot = F.col("snapshot_date")
    out = out.withColumn(
        "first_missed_date", loans.first_missed_date(snapshot, F.col("installments_missed"))
    )
    return out.withColumn(
        "dpd", loans.days_past_due(snapshot, F.col("first_missed_date"), overdue).cast("int")
    )


def silver_loans(raw: DataFrame, guard_zero_due: bool = True) -> DataFrame:
    return loan_arrears(enforce_schema(raw, schemas.LOAN_DAILY), guard_zero_due)


def silver_clicks(raw: DataFrame) -> DataFrame:
    """Click records per customer and snapshot."""
    typed = raw.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
    )
    return typed.groupBy("Customer_ID", "snapshot_date").agg(F.count("*").alias("total_clicks"))


def silver_attributes(raw: DataFrame, strict: bool = False, drop_personal: bool = False) -> DataFrame:
    """Typed ids and dates, a numeric age and its band.

    ``strict`` keeps the sign of an age, rejects impossible ones and leaves the
    band of an unknown age null.
    """
    out = {}
    for name in raw.columns:
        out[name] = F.col(name)
    if "Customer_ID" in out:
        out["Customer_ID"] = F.col("Customer_ID").cast("string")
    if "Income_Level" in out:
        out["Income_Level"] = F.col("Income_Level").try_cast("float")
    if "snapshot_date" in out:
        out["snapshot_date"] = F.col("snapshot_date").try_cast("date")
    if "Age" in out:
        text = F.col("Age").cast("string")
        age = cleaning.signed_age(text) if strict else cleaning.digits_to_int(text)
        out["Age"] = age
        out["Age_Group"] = cleaning.age_band(age, None if strict else cleaning.LAST_AGE_BAND)
    if drop_personal:
        out.pop("SSN", None)
        out.pop("Name", None)
    return raw.select([column.alias(name) for name, column in out.items()])


FINANCIAL_TEXT = (
    "Customer_ID",
    "snapshot_date",
    "Credit_Mix",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
    "Type_of_Loan",
)


def silver_financials(raw: DataFrame, strict_lists: bool = False) -> DataFrame:
    """Encoded categories beside the raw text; all other columns read as numbers."""
    present = set(raw.columns)
    out = {}
    for name in raw.columns:
        if name in FINANCIAL_TEXT:
            out[name] = F.col(name)
        else:
            out[name] = cleaning.clean_number(F.col(name).cast("string"))
    if "Customer_ID" in present:
        out["Customer_ID"] = F.col("Customer_ID").cast("string")
    if "snapshot_date" in present:
        out["snapshot_date"] = F.col("snapshot_date").try_cast("date")
    if "Credit_Mix" in present:
        out["Credit_Mix_Score"] = cleaning.encode(
            F.col("Credit_Mix"), cleaning.CREDIT_MIX_SCORE
        )
    if "Credit_History_Age" in present:
        out["Credit_History_Months"] = cleaning.duration_months(F.col("Credit_History_Age"))
    if "Payment_of_Min_Amount" in present:
        out["Payment_Min_Amount_Flag"] = cleaning.encode(
            F.col("Payment_of_Min_Amount"), cleaning.YES_NO_FLAG
        )
    if "Payment_Behaviour" in present:
        out["Payment_Behaviour_Clean"] = cleaning.keep_matching(F.col("Payment_Behaviour"))
    if "Type_of_Loan" in present:
        text = F.col("Type_of_Loan").cast("string")
        out["Type_of_Loan_Text"] = text
        out["Type_of_Loan_Count"] = cleaning.count_list_items(text, strict_lists)
    return raw.select([column.alias(name) for name, column in out.items()])


def label_store(df: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Label of each loan at a fixed month on book."""
    return df.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        loans.default_flag(F.col("dpd"), dpd).alias("label"),
        F.lit(loans.label_definition(dpd, mob)).alias("label_def"),
        "snapshot_date",
    )


def add_row_label(
    df: DataFrame, dpd: int = 30, mob: int = 6, name: str = "label_default_30dpd"
) -> DataFrame:
    """Label from the row's own arrears; without ``mob`` by days past due alone."""
    if "dpd" not in df.columns:
        return df
    if "mob" in df.columns:
        return df.withColumn(
            name, loans.default_flag_from_mob(F.col("dpd"), F.col("mob"), dpd, mob)
        )
    return df.withColumn(name, loans.default_flag(F.col("dpd"), dpd))


# --- user schema ----------------------------------------------------------


def silver_user_loans(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "loan_age_days": loans.loan_age_days(F.col("snapshot_date"), F.col("origination_date")),
            "monthly_payment": loans.annuity_payment(
                F.col("loan_amount"), F.col("interest_rate"), F.col("term_months")
            ),
            "status_clean": cleaning.clean_label(F.col("loan_status")),
        }
    )


def silver_user_attributes(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "gender_encoded": cleaning.encode(F.col("gender"), cleaning.GENDER_CODE),
            "education_years": cleaning.encode(F.col("education"), cleaning.EDUCATION_YEARS),
            "is_employed": cleaning.equals_flag(F.col("employment_status"), "Employed"),
            "is_married": cleaning.equals_flag(F.col("marital_status"), "Married"),
        }
    )


def silver_user_financials(raw: DataFrame) -> DataFrame:
    """Income, debt and asset ratios; a ratio that does not exist is 0, as is any null or
    infinite value of the frame."""
    income = F.col("annual_income") / F.lit(12)
    ratios = raw.withColumns(
        {
            "debt_to_income": cleaning.divide_or_zero(F.col("credit_card_balance"), income),
            "savings_to_income": cleaning.divide_or_zero(F.col("savings_balance"), income),
            "credit_utilization": cleaning.divide_or_zero(
                F.col("credit_card_balance"), F.col("credit_card_limit")
            ),
            "monthly_discretionary_income": income - F.col("monthly_expenses"),
            "total_liquid_assets": F.col("savings_balance") + F.col("checking_balance"),
            "net_worth_estimate": F.col("savings_balance")
            + F.col("checking_balance")
            - F.col("credit_card_balance"),
        }
    )
    return fill_numeric_nulls(zero_infinite(ratios))


def add_risk_score(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Additive rule score from (debt ratio, score, utilization, years employed)."""
    names = columns or (
        "debt_to_income", "credit_score", "utilization_rate", "employment_length_years",
    )
    return df.withColumn("default_prob", loans.rule_risk_score(*[F.col(n) for n in names]))
