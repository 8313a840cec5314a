"""Explicit schemas, so that no scan needs an inference pass.

Fixed values: column names and types of the extracts and stores.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


def raw_text(schema: StructType) -> StructType:
    """The same columns as text: what a dirty CSV is read as before typing."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


# --- lending schema -------------------------------------------------------

LOAN_DAILY = _struct(
    ("loan_id", StringType()),
    ("Customer_ID", StringType()),
    ("loan_start_date", DateType()),
    ("tenure", IntegerType()),
    ("installment_num", IntegerType()),
    ("loan_amt", FloatType()),
    ("due_amt", FloatType()),
    ("paid_amt", FloatType()),
    ("overdue_amt", FloatType()),
    ("balance", FloatType()),
    ("snapshot_date", DateType()),
)

ATTRIBUTES_RAW = _struct(
    ("Customer_ID", StringType()),
    ("Name", StringType()),
    ("Age", StringType()),
    ("SSN", StringType()),
    ("Occupation", StringType()),
    ("snapshot_date", DateType()),
)

FINANCIAL_NUMERIC = (
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
)

FINANCIALS_RAW = _struct(
    ("Customer_ID", StringType()),
    *[(name, StringType()) for name in FINANCIAL_NUMERIC],
    ("Credit_Mix", StringType()),
    ("Credit_History_Age", StringType()),
    ("Payment_of_Min_Amount", StringType()),
    ("Payment_Behaviour", StringType()),
    ("Type_of_Loan", StringType()),
    ("snapshot_date", DateType()),
)

# --- user schema ----------------------------------------------------------

USER_LOANS = _struct(
    ("loan_id", StringType()),
    ("user_id", StringType()),
    ("loan_amount", DoubleType()),
    ("interest_rate", DoubleType()),
    ("term_months", LongType()),
    ("origination_date", StringType()),
    ("loan_status", StringType()),
    ("snapshot_date", StringType()),
)

USER_CLICKS = _struct(
    ("event_id", StringType()),
    ("user_id", StringType()),
    ("event_type", StringType()),
    ("event_timestamp", StringType()),
    ("snapshot_date", StringType()),
)

USER_ATTRIBUTES = _struct(
    ("user_id", StringType()),
    ("age", LongType()),
    ("gender", StringType()),
    ("education", StringType()),
    ("employment_status", StringType()),
    ("marital_status", StringType()),
    ("num_dependents", LongType()),
    ("snapshot_date", StringType()),
)

USER_FINANCIALS = _struct(
    ("user_id", StringType()),
    ("annual_income", DoubleType()),
    ("monthly_expenses", DoubleType()),
    ("savings_balance", DoubleType()),
    ("checking_balance", DoubleType()),
    ("credit_card_balance", DoubleType()),
    ("credit_card_limit", DoubleType()),
    ("num_credit_cards", LongType()),
    ("num_bank_accounts", LongType()),
    ("has_mortgage", LongType()),
    ("has_auto_loan", LongType()),
    ("credit_score", LongType()),
    ("snapshot_date", StringType()),
)

# --- model lifecycle ------------------------------------------------------

METRICS = _struct(
    ("auc", DoubleType()),
    ("precision", DoubleType()),
    ("recall", DoubleType()),
    ("f1", DoubleType()),
    ("confusion_matrix", ArrayType(ArrayType(LongType()))),
)

MODEL_REGISTRY = _struct(
    ("model_name", StringType()),
    ("model_path", StringType()),
    ("timestamp", TimestampType()),
    ("metrics", METRICS),
    ("feature_columns", ArrayType(StringType())),
    ("n_features", IntegerType()),
    ("all_models_comparison", MapType(StringType(), METRICS)),
    ("selection_criteria", StringType()),
    (
        "data_leakage_prevention",
        _struct(
            ("temporal_split", StringType()),
            ("leakage_features_removed", StringType()),
            ("description", StringType()),
        ),
    ),
    ("deployment_ready", StringType()),
    ("version", StringType()),
)
