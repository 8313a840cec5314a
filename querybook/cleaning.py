"""Cleaning of the customer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import views
from querybook.registry import query
from querybook.views import day_text
from vintagemart.functions import cleaning
from vintagemart.operators import columns, snapshots


@query(
    "clean_age",
    """SELECT Customer_ID, clean_age AS Age, Age_Group, Occupation,
              CAST(snapshot_date AS VARCHAR) AS snapshot_date
       FROM v_clean_age""",
)
def clean_age(spark, sf_dir):
    df = snapshots.silver_attributes(views.attributes(spark, sf_dir), drop_personal=True)
    return day_text(df, "snapshot_date")


@query(
    "clean_age_strict",
    """SELECT Customer_ID, Age, CASE WHEN Age IS NULL THEN NULL WHEN Age < 25 THEN 'Youth'
                                     WHEN Age < 45 THEN 'Adult' WHEN Age < 65 THEN 'Middle-aged'
                                     ELSE 'Senior' END AS Age_Group
       FROM (SELECT Customer_ID, CASE WHEN a BETWEEN 0 AND 120 THEN a END AS Age
             FROM (SELECT Customer_ID, TRY_CAST(regexp_replace(Age, '[^0-9\\-]', '', 'g') AS INTEGER)
                          AS a FROM v_attributes))""",
)
def clean_age_strict(spark, sf_dir):
    df = snapshots.silver_attributes(views.attributes(spark, sf_dir), strict=True)
    return df.select("Customer_ID", "Age", "Age_Group")


@query(
    "clean_numeric_columns",
    """SELECT Customer_ID, CAST(clean_income AS DOUBLE) AS Annual_Income,
              CAST(clean_debt AS DOUBLE) AS Outstanding_Debt
       FROM v_silver_financials""",
)
def clean_numeric_columns(spark, sf_dir):
    df = snapshots.silver_financials(views.financials(spark, sf_dir))
    return df.select(
        "Customer_ID",
        F.col("Annual_Income").cast("double").alias("Annual_Income"),
        F.col("Outstanding_Debt").cast("double").alias("Outstanding_Debt"),
    )


@query(
    "ordinal_encode",
    """SELECT f.Customer_ID, Credit_Mix_Score, Payment_Min_Amount_Flag,
              CASE gender WHEN 'M' THEN 0 WHEN 'F' THEN 1 WHEN 'Other' THEN 2 END
                  AS gender_encoded,
              CASE education WHEN 'High School' THEN 12 WHEN 'Bachelor' THEN 16
                             WHEN 'Master' THEN 18 WHEN 'PhD' THEN 21 END AS education_years
       FROM v_silver_financials f JOIN v_user_attributes a ON f.Customer_ID = a.user_id""",
)
def ordinal_encode(spark, sf_dir):
    financials = snapshots.silver_financials(views.financials(spark, sf_dir)).select(
        "Customer_ID", "Credit_Mix_Score", "Payment_Min_Amount_Flag"
    )
    attributes = snapshots.silver_user_attributes(views.user_attributes(spark, sf_dir)).select(
        F.col("user_id").alias("Customer_ID"), "gender_encoded", "education_years"
    )
    return financials.join(attributes, "Customer_ID")


@query(
    "parse_duration_months",
    "SELECT Customer_ID, Credit_History_Months FROM v_silver_financials",
)
def parse_duration_months(spark, sf_dir):
    df = snapshots.silver_financials(views.financials(spark, sf_dir))
    return df.select("Customer_ID", "Credit_History_Months")


@query("regex_whitelist", "SELECT Customer_ID, Payment_Behaviour_Clean FROM v_silver_financials")
def regex_whitelist(spark, sf_dir):
    df = snapshots.silver_financials(views.financials(spark, sf_dir))
    return df.select("Customer_ID", "Payment_Behaviour_Clean")


@query(
    "count_list_items",
    """SELECT Customer_ID, Type_of_Loan AS Type_of_Loan_Text,
              CAST(Type_of_Loan_Count AS INTEGER) AS Type_of_Loan_Count,
              CAST(CASE WHEN Type_of_Loan IS NULL THEN 0 ELSE len(regexp_split_to_array(
                   regexp_replace(Type_of_Loan, '(\\s*,)?\\s+and\\s+', ',', 'g'), '\\s*,\\s*')) END
                   AS INTEGER) AS strict_count
       FROM v_silver_financials""",
)
def count_list_items(spark, sf_dir):
    df = snapshots.silver_financials(views.financials(spark, sf_dir))
    return df.select(
        "Customer_ID",
        "Type_of_Loan_Text",
        "Type_of_Loan_Count",
        cleaning.count_list_items(F.col("Type_of_Loan_Text"), strict=True).alias("strict_count"),
    )


@query(
    "indicator_flags",
    """SELECT user_id, CASE WHEN employment_status = 'Employed' THEN 1 ELSE 0 END AS is_employed,
              CASE WHEN marital_status = 'Married' THEN 1 ELSE 0 END AS is_married
       FROM v_user_attributes""",
)
def indicator_flags(spark, sf_dir):
    df = snapshots.silver_user_attributes(views.user_attributes(spark, sf_dir))
    return df.select("user_id", "is_employed", "is_married")


_RATIOS = """
    SELECT user_id,
           coalesce(credit_card_balance / nullif(annual_income / 12, 0), 0) AS debt_to_income,
           coalesce(savings_balance / nullif(annual_income / 12, 0), 0) AS savings_to_income,
           coalesce(credit_card_balance / nullif(credit_card_limit, 0), 0) AS credit_utilization,
           annual_income / 12 - monthly_expenses AS monthly_discretionary_income,
           CASE WHEN isfinite(savings_balance + checking_balance)
                THEN savings_balance + checking_balance ELSE 0 END AS total_liquid_assets,
           CASE WHEN isfinite(savings_balance + checking_balance)
                THEN savings_balance + checking_balance - credit_card_balance ELSE 0 END
               AS net_worth_estimate,
           coalesce(credit_score, 0) AS credit_score, employment_length_years
    FROM v_user_financials"""


@query(
    "financial_ratios",
    f"""SELECT user_id, round(debt_to_income, 8) AS debt_to_income,
               round(savings_to_income, 8) AS savings_to_income, credit_utilization,
               monthly_discretionary_income, total_liquid_assets, net_worth_estimate
        FROM ({_RATIOS})""",
)
def financial_ratios(spark, sf_dir):
    df = snapshots.silver_user_financials(views.user_financials(spark, sf_dir))
    return df.select(
        "user_id",
        F.round("debt_to_income", 8).alias("debt_to_income"),
        F.round("savings_to_income", 8).alias("savings_to_income"),
        "credit_utilization",
        "monthly_discretionary_income",
        "total_liquid_assets",
        "net_worth_estimate",
    )


@query(
    "fill_numeric_nulls",
    """SELECT user_id, coalesce(savings_balance, 0) AS savings_balance,
              CAST(coalesce(credit_score, 0) AS BIGINT) AS credit_score
       FROM v_user_financials""",
)
def fill_numeric_nulls(spark, sf_dir):
    df = columns.fill_numeric_nulls(views.user_financials(spark, sf_dir))
    return df.select("user_id", "savings_balance", "credit_score")


@query(
    "clip_values",
    """SELECT user_id, greatest(500, least(700, credit_score)) AS credit_score,
              least(1000.0::DOUBLE, savings_balance) AS savings_balance,
              greatest(20000.0::DOUBLE, annual_income) AS annual_income
       FROM (SELECT user_id, credit_score, annual_income,
                    CASE WHEN savings_balance IS NOT NULL THEN savings_balance END
                        AS savings_balance FROM v_user_financials)
       WHERE credit_score IS NOT NULL AND savings_balance IS NOT NULL
       UNION ALL
       SELECT user_id, CASE WHEN credit_score IS NOT NULL
                            THEN greatest(500, least(700, credit_score)) END,
              CASE WHEN savings_balance IS NOT NULL
                   THEN least(1000.0::DOUBLE, savings_balance) END,
              greatest(20000.0::DOUBLE, annual_income)
       FROM v_user_financials WHERE credit_score IS NULL OR savings_balance IS NULL""",
)
def clip_values(spark, sf_dir):
    return views.user_financials(spark, sf_dir).select(
        "user_id",
        cleaning.clip(F.col("credit_score"), 500, 700).alias("credit_score"),
        cleaning.clip(F.col("savings_balance"), upper=1000.0).alias("savings_balance"),
        cleaning.clip(F.col("annual_income"), lower=20000.0).alias("annual_income"),
    )


@query(
    "rule_risk_score",
    f"""SELECT user_id, round(0.05::DOUBLE
               + CASE WHEN debt_to_income > 0.4 THEN 0.02::DOUBLE ELSE 0 END
               + CASE WHEN credit_score < 600 THEN 0.03::DOUBLE ELSE 0 END
               + CASE WHEN credit_utilization > 0.7 THEN 0.02::DOUBLE ELSE 0 END
               + CASE WHEN employment_length_years < 2 THEN 0.01::DOUBLE ELSE 0 END, 6)
               AS default_prob
        FROM ({_RATIOS})""",
)
def rule_risk_score(spark, sf_dir):
    ratios = snapshots.silver_user_financials(views.user_financials(spark, sf_dir))
    scored = snapshots.add_risk_score(
        ratios,
        ("debt_to_income", "credit_score", "credit_utilization", "employment_length_years"),
    )
    return scored.select("user_id", F.round("default_prob", 6).alias("default_prob"))
