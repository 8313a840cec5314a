"""Lending-shaped views of the given tables, once for Spark and once as SQL text.

Both sides use the same integer arithmetic on keys, so that dirty values, zero
divisors, nulls and join misses occur at the same rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemart.operators import snapshots

FIRST_MONTH = "1995-01-01"
N_MONTHS = 80


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(cases: list[tuple[Column, Column]], default: Column) -> Column:
    (first, value), *rest = cases
    return reduce(lambda acc, c: acc.when(c[0], c[1]), rest, F.when(first, value)).otherwise(default)


def day_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as ISO text, the form in which both engines are compared."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# --- loans ----------------------------------------------------------------


def loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan row per order; nothing is due at installment 0."""
    key = F.col("o_orderkey")
    start = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    installment = (key % 11).cast("int")
    due = F.when(installment == 0, F.lit(0.0)).otherwise(F.lit(100.0))
    overdue = due * (key % 4) + (key % 3) * F.lit(7.5)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("LOAN_"), key.cast("string")).alias("loan_id"),
        F.concat(F.lit("CUS_"), F.col("o_custkey").cast("string")).alias("Customer_ID"),
        start.alias("loan_start_date"),
        F.lit(10).alias("tenure"),
        installment.alias("installment_num"),
        F.floor("o_totalprice").cast("float").alias("loan_amt"),
        due.cast("float").alias("due_amt"),
        (due * (key % 2)).cast("float").alias("paid_amt"),
        overdue.cast("float").alias("overdue_amt"),
        ((F.lit(10) - installment) * 100).cast("float").alias("balance"),
        F.add_months(start, installment).alias("snapshot_date"),
    )


def loan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan rows as text with junk: what a dirty extract is read as."""
    key = F.regexp_extract("loan_id", r"(\d+)", 1).cast("bigint")
    df = loan(spark, sf_dir)
    return df.select(
        [
            _pick(
                [(key % 17 == 0, F.lit("n/a")), (key % 19 == 0, F.lit(""))],
                F.col(c).cast("bigint").cast("string"),
            ).alias(c)
            if c in ("due_amt", "loan_amt", "installment_num")
            else F.col(c).cast("string").alias(c)
            for c in df.columns
        ]
    )


def silver_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.loan_arrears(loan(spark, sf_dir))


def user_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per line item; rate 0 occurs."""
    shipped = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.lit("LOAN"), F.col("l_orderkey"), F.col("l_partkey")).alias("loan_id"),
        F.concat(F.lit("USER_"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias(
            "user_id"
        ),
        F.floor("l_extendedprice").cast("double").alias("loan_amount"),
        F.col("l_discount").alias("interest_rate"),
        (F.lit(12) * (F.lit(1) + F.col("l_linenumber") % 5)).cast("bigint").alias("term_months"),
        shipped.cast("string").alias("origination_date"),
        F.concat(F.lit(" \t"), F.col("l_linestatus"), F.lit("CTIVE ")).alias("loan_status"),
        F.add_months(F.trunc(shipped, "MM"), 3).cast("string").alias("snapshot_date"),
    )


# --- customer tables ------------------------------------------------------


def click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("CUS_"), F.col("user_id").cast("string")).alias("Customer_ID"),
        F.col("ts").cast("date").alias("snapshot_date"),
        "event_type",
    )


def click_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click features per customer, spread over the order months."""
    month = F.add_months(F.lit(FIRST_MONTH).cast("date"), (F.col("event_id") % N_MONTHS).cast("int"))
    clicks = table(spark, sf_dir, "events").select(
        F.concat(F.lit("CUS_"), F.col("user_id").cast("string")).alias("Customer_ID"),
        month.alias("snapshot_date"),
        "event_type",
    )
    return clicks.groupBy("Customer_ID", "snapshot_date").agg(
        F.count("*").alias("fe_1"),
        F.count_if(F.col("event_type") == "click").alias("fe_2"),
        F.count_if(F.col("event_type") == "purchase").alias("fe_3"),
    )


def _customer_keys() -> tuple[Column, Column]:
    key = F.col("c_custkey")
    month = F.add_months(F.lit(FIRST_MONTH).cast("date"), (key % N_MONTHS).cast("int"))
    return F.concat(F.lit("CUS_"), key.cast("string")), month


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    customer, month = _customer_keys()
    age = (key % 90).cast("string")
    return table(spark, sf_dir, "customer").select(
        customer.alias("Customer_ID"),
        F.col("c_name").alias("Name"),
        _pick(
            [
                (key % 29 == 0, F.lit(None).cast("string")),
                (key % 13 == 0, F.concat(F.lit("-"), age, F.lit("00"))),
                (key % 11 == 0, F.lit("")),
                (key % 7 == 0, F.concat(age, F.lit("_"))),
            ],
            age,
        ).alias("Age"),
        F.when(key % 17 == 0, F.lit("_______")).otherwise(F.col("c_mktsegment")).alias(
            "Occupation"
        ),
        month.alias("snapshot_date"),
    )


def user_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    customer, month = _customer_keys()
    return table(spark, sf_dir, "customer").select(
        customer.alias("user_id"),
        _pick(
            [
                (key % 5 == 0, F.lit("F")),
                (key % 5 == 1, F.lit("M")),
                (key % 5 == 2, F.lit("Other")),
                (key % 5 == 3, F.lit("?")),
            ],
            F.lit(None).cast("string"),
        ).alias("gender"),
        _pick(
            [
                (key % 6 == 0, F.lit("High School")),
                (key % 6 == 1, F.lit("Bachelor")),
                (key % 6 == 2, F.lit("Master")),
                (key % 6 == 3, F.lit("PhD")),
                (key % 6 == 4, F.lit("None")),
            ],
            F.lit(None).cast("string"),
        ).alias("education"),
        _pick(
            [(key % 3 == 0, F.lit("Employed")), (key % 3 == 1, F.lit("Retired"))],
            F.lit(None).cast("string"),
        ).alias("employment_status"),
        F.when(key % 2 == 0, "Married").otherwise("Single").alias("marital_status"),
        month.alias("snapshot_date"),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text columns of the lending schema, debts from the customer's orders."""
    key = F.col("c_custkey")
    customer, month = _customer_keys()
    whole = F.floor("c_acctbal").cast("bigint").cast("string")
    debts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    joined = table(spark, sf_dir, "customer").join(
        debts, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return joined.select(
        customer.alias("Customer_ID"),
        _pick(
            [(key % 19 == 0, F.lit("--")), (key % 23 == 0, F.lit("")), (key % 5 == 0,
              F.concat(whole, F.lit("_")))],
            whole,
        ).alias("Annual_Income"),
        F.concat(F.col("n_orders").cast("string"), F.lit("00.5_")).alias("Outstanding_Debt"),
        _pick(
            [
                (key % 4 == 0, F.lit("Bad")),
                (key % 4 == 1, F.lit("Standard")),
                (key % 4 == 2, F.lit("Good")),
            ],
            F.lit("_"),
        ).alias("Credit_Mix"),
        _pick(
            [
                (key % 5 == 0, F.lit("NA")),
                (key % 5 == 1, F.lit("1 Year and 3 Months")),
                (key % 5 == 2, F.lit(None).cast("string")),
            ],
            F.concat(
                (key % 40).cast("string"),
                F.lit(" Years and "),
                (key % 12).cast("string"),
                F.lit(" Months"),
            ),
        ).alias("Credit_History_Age"),
        _pick([(key % 3 == 0, F.lit("Yes")), (key % 3 == 1, F.lit("No"))], F.lit("NM")).alias(
            "Payment_of_Min_Amount"
        ),
        _pick(
            [
                (key % 4 == 0, F.lit("Low_spent_Small_value_payments")),
                (key % 4 == 1, F.lit("!@9#%8")),
                (key % 4 == 2, F.lit("High_spent")),
            ],
            F.lit(None).cast("string"),
        ).alias("Payment_Behaviour"),
        _pick(
            [
                (key % 5 == 0, F.lit(None).cast("string")),
                (key % 5 == 1, F.lit("Auto Loan")),
                (key % 5 == 2, F.lit("Auto Loan and Home Loan")),
                (key % 5 == 3, F.lit("Auto Loan, Home Loan, and Payday Loan")),
            ],
            F.lit("Auto Loan , Home Loan"),
        ).alias("Type_of_Loan"),
        month.alias("snapshot_date"),
    )


def user_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number amounts with zero incomes and limits, missing savings, infinite balances."""
    key = F.col("c_custkey")
    customer, month = _customer_keys()
    balance = F.floor(F.abs("c_acctbal")).cast("double")
    return table(spark, sf_dir, "customer").select(
        customer.alias("user_id"),
        F.when(key % 10 == 0, F.lit(0.0)).otherwise(balance * 12).alias("annual_income"),
        (key % 900).cast("double").alias("monthly_expenses"),
        F.when(key % 31 == 0, F.lit(None).cast("double"))
        .otherwise((key % 5000).cast("double"))
        .alias("savings_balance"),
        F.when(key % 43 == 0, F.lit(float("inf")))
        .otherwise((key % 700).cast("double"))
        .alias("checking_balance"),
        F.when(key % 20 == 0, F.lit(0.0))
        .otherwise((key % 3000).cast("double"))
        .alias("credit_card_balance"),
        F.when(key % 7 == 0, F.lit(0.0)).otherwise(F.lit(5000.0)).alias("credit_card_limit"),
        F.when(key % 37 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.lit(300) + key % 550)
        .alias("credit_score"),
        (key % 40).cast("double").alias("employment_length_years"),
        month.alias("snapshot_date"),
    )


# --- predictions and features ---------------------------------------------


def prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows; every day has both classes."""
    score = F.col("value") / F.lit(500.0)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("CUS_"), F.col("user_id").cast("string")).alias("Customer_ID"),
        F.concat(F.lit("LOAN_"), F.col("event_id").cast("string")).alias("loan_id"),
        F.col("ts").cast("date").alias("snapshot_date"),
        score.alias("prediction_probability"),
        (score >= 0.1).cast("int").alias("prediction_binary"),
        (F.col("event_type") == "error").cast("int").alias("actual_label"),
    )


def prediction_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores that lie exactly on bin edges."""
    return table(spark, sf_dir, "lineitem").select(
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("snapshot_date"),
        (F.col("l_discount") * F.lit(10.0)).alias("prediction_probability"),
    )


def feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part features: one constant, one linear copy, one dirty text, leaked columns."""
    key = F.col("p_partkey")
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("quantity"),
        )
    )
    joined = table(spark, sf_dir, "part").join(
        sold, F.col("p_partkey") == F.col("l_partkey"), "left"
    )
    return joined.select(
        F.concat(F.lit("CUS_"), key.cast("string")).alias("user_id"),
        F.add_months(F.lit("2023-01-01").cast("date"), (key % 24).cast("int")).alias(
            "snapshot_date"
        ),
        F.col("p_size").cast("double").alias("fe_size"),
        F.floor("p_retailprice").cast("double").alias("fe_price"),
        F.col("n_lines").cast("double").alias("fe_lines"),
        F.col("quantity").alias("fe_quantity"),
        F.lit(1.0).alias("fe_const"),
        (F.col("p_size") * 2 + 1).cast("double").alias("fe_size_copy"),
        _pick(
            [
                (key % 9 == 0, F.lit("junk")),
                (key % 10 == 0, F.lit(None).cast("string")),
                (key % 13 == 0, F.lit("5d")),
            ],
            (key % 50).cast("string"),
        ).alias("fe_text"),
        (key % 90).cast("int").alias("dpd"),
        (key % 11).cast("int").alias("mob"),
        (key % 1000).cast("double").alias("balance"),
        (F.col("p_size") % 2).cast("int").alias("label"),
    )


def vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a binary target; about a fifth is positive."""
    key = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        key.alias("id"),
        F.concat(F.lit("CUS_"), key.cast("string")).alias("Customer_ID"),
        F.add_months(F.lit("2023-01-01").cast("date"), (key % 24).cast("int")).alias(
            "snapshot_date"
        ),
        F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") < 2).cast("int").alias("label"),
    )


# --- the same views as SQL ------------------------------------------------

_MONTH = (
    "CAST(DATE '1995-01-01' + to_months(CAST({key} % 80 AS INTEGER)) AS DATE)"
)
_CUSTOMER_MONTH = _MONTH.format(key="c_custkey")

VIEW_SQL = {
    "v_loan": """
        SELECT 'LOAN_' || o_orderkey AS loan_id, 'CUS_' || o_custkey AS Customer_ID,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS loan_start_date,
               10 AS tenure, CAST(o_orderkey % 11 AS INTEGER) AS installment_num,
               CAST(floor(o_totalprice) AS FLOAT) AS loan_amt,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 100 END AS FLOAT) AS due_amt,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 100 END * (o_orderkey % 2) AS FLOAT)
                   AS paid_amt,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 100 END * (o_orderkey % 4)
                    + (o_orderkey % 3) * 7.5 AS FLOAT) AS overdue_amt,
               CAST((10 - o_orderkey % 11) * 100 AS FLOAT) AS balance,
               CAST(CAST(date_trunc('month', o_orderdate) AS DATE)
                    + to_months(CAST(o_orderkey % 11 AS INTEGER)) AS DATE) AS snapshot_date,
               o_orderkey AS loan_key
        FROM orders""",
    "v_silver_loan": """
        SELECT *, CASE WHEN overdue_amt > 0
                       THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER)
                       ELSE 0 END AS dpd
        FROM (SELECT *, CASE WHEN installments_missed > 0
                             THEN CAST(snapshot_date - to_months(installments_missed) AS DATE)
                             END AS first_missed_date
              FROM (SELECT *, installment_num AS mob,
                           CAST(CASE WHEN due_amt <> 0
                                     THEN ceil(CAST(overdue_amt AS DOUBLE) / CAST(due_amt AS DOUBLE))
                                     ELSE 0 END AS INTEGER) AS installments_missed
                    FROM v_loan))""",
    "v_labels": """
        SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
               '30dpd_6mob' AS label_def, snapshot_date
        FROM v_silver_loan WHERE mob = 6""",
    "v_user_loan": """
        SELECT 'LOAN_' || l_orderkey || '_' || l_partkey AS loan_id,
               'USER_' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS user_id,
               CAST(floor(l_extendedprice) AS DOUBLE) AS loan_amount, l_discount AS interest_rate,
               CAST(12 * (1 + l_linenumber % 5) AS BIGINT) AS term_months,
               CAST(l_shipdate AS DATE) AS origination_date,
               ' ' || chr(9) || l_linestatus || 'CTIVE ' AS loan_status,
               CAST(CAST(date_trunc('month', l_shipdate) AS DATE) + to_months(3) AS DATE)
                   AS snapshot_date
        FROM lineitem""",
    "v_silver_user_loan": """
        SELECT *, CAST(date_diff('day', origination_date, snapshot_date) AS INTEGER)
                      AS loan_age_days,
               CASE WHEN interest_rate > 0
                    THEN loan_amount * (interest_rate / 12)
                         * pow(1.0::DOUBLE + interest_rate / 12, term_months)
                         / (pow(1.0::DOUBLE + interest_rate / 12, term_months) - 1.0::DOUBLE)
                    END AS monthly_payment,
               trim(lower(loan_status), ' ' || chr(9)) AS status_clean
        FROM v_user_loan""",
    "v_click": """
        SELECT event_id, 'CUS_' || user_id AS Customer_ID, CAST(ts AS DATE) AS snapshot_date,
               event_type
        FROM events""",
    "v_click_month": f"""
        SELECT 'CUS_' || user_id AS Customer_ID, {_MONTH.format(key="event_id")} AS snapshot_date,
               count(*) AS fe_1, count(*) FILTER (event_type = 'click') AS fe_2,
               count(*) FILTER (event_type = 'purchase') AS fe_3
        FROM events GROUP BY 1, 2""",
    "v_attributes": f"""
        SELECT 'CUS_' || c_custkey AS Customer_ID, c_name AS Name,
               CASE WHEN c_custkey % 29 = 0 THEN NULL
                    WHEN c_custkey % 13 = 0 THEN '-' || (c_custkey % 90) || '00'
                    WHEN c_custkey % 11 = 0 THEN ''
                    WHEN c_custkey % 7 = 0 THEN (c_custkey % 90) || '_'
                    ELSE CAST(c_custkey % 90 AS VARCHAR) END AS Age,
               CASE WHEN c_custkey % 17 = 0 THEN '_______' ELSE c_mktsegment END AS Occupation,
               {_CUSTOMER_MONTH} AS snapshot_date
        FROM customer""",
    "v_clean_age": """
        SELECT Customer_ID, Occupation, snapshot_date, clean_age,
               CASE WHEN clean_age < 25 THEN 'Youth' WHEN clean_age < 45 THEN 'Adult'
                    WHEN clean_age < 65 THEN 'Middle-aged' ELSE 'Senior' END AS Age_Group
        FROM (SELECT *, TRY_CAST(regexp_replace(Age, '[^0-9]', '', 'g') AS INTEGER) AS clean_age
              FROM v_attributes)""",
    "v_user_attributes": f"""
        SELECT 'CUS_' || c_custkey AS user_id,
               CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'Other'
                                  WHEN 3 THEN '?' END AS gender,
               CASE c_custkey % 6 WHEN 0 THEN 'High School' WHEN 1 THEN 'Bachelor'
                                  WHEN 2 THEN 'Master' WHEN 3 THEN 'PhD' WHEN 4 THEN 'None' END
                   AS education,
               CASE c_custkey % 3 WHEN 0 THEN 'Employed' WHEN 1 THEN 'Retired' END
                   AS employment_status,
               CASE WHEN c_custkey % 2 = 0 THEN 'Married' ELSE 'Single' END AS marital_status,
               {_CUSTOMER_MONTH} AS snapshot_date
        FROM customer""",
    "v_financials": f"""
        SELECT 'CUS_' || c_custkey AS Customer_ID,
               CASE WHEN c_custkey % 19 = 0 THEN '--' WHEN c_custkey % 23 = 0 THEN ''
                    WHEN c_custkey % 5 = 0 THEN CAST(floor(c_acctbal) AS BIGINT) || '_'
                    ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS Annual_Income,
               n_orders || '00.5_' AS Outstanding_Debt,
               CASE c_custkey % 4 WHEN 0 THEN 'Bad' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Good'
                                  ELSE '_' END AS Credit_Mix,
               CASE c_custkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN '1 Year and 3 Months'
                                  WHEN 2 THEN NULL
                                  ELSE (c_custkey % 40) || ' Years and ' || (c_custkey % 12)
                                       || ' Months' END AS Credit_History_Age,
               CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END
                   AS Payment_of_Min_Amount,
               CASE c_custkey % 4 WHEN 0 THEN 'Low_spent_Small_value_payments'
                                  WHEN 1 THEN '!@9#%8' WHEN 2 THEN 'High_spent' END
                   AS Payment_Behaviour,
               CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Auto Loan'
                                  WHEN 2 THEN 'Auto Loan and Home Loan'
                                  WHEN 3 THEN 'Auto Loan, Home Loan, and Payday Loan'
                                  ELSE 'Auto Loan , Home Loan' END AS Type_of_Loan,
               {_CUSTOMER_MONTH} AS snapshot_date
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
             ON c_custkey = o_custkey""",
    "v_silver_financials": """
        SELECT *,
               TRY_CAST(regexp_replace(Annual_Income, '[^0-9.\\-]', '', 'g') AS FLOAT)
                   AS clean_income,
               TRY_CAST(regexp_replace(Outstanding_Debt, '[^0-9.\\-]', '', 'g') AS FLOAT)
                   AS clean_debt,
               CASE Credit_Mix WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 WHEN 'Good' THEN 2 END
                   AS Credit_Mix_Score,
               TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years', 1) AS INTEGER) * 12
                   + TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months', 1) AS INTEGER)
                   AS Credit_History_Months,
               CASE Payment_of_Min_Amount WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END
                   AS Payment_Min_Amount_Flag,
               CASE WHEN regexp_matches(Payment_Behaviour, '^[A-Za-z_]+$') THEN Payment_Behaviour
                    ELSE 'Unknown' END AS Payment_Behaviour_Clean,
               CASE WHEN Type_of_Loan IS NULL THEN 0 ELSE len(regexp_split_to_array(
                    regexp_replace(Type_of_Loan, '\\s+and\\s+', ',', 'g'), '\\s*,\\s*')) END
                   AS Type_of_Loan_Count
        FROM v_financials""",
    "v_user_financials": f"""
        SELECT 'CUS_' || c_custkey AS user_id,
               CASE WHEN c_custkey % 10 = 0 THEN 0.0::DOUBLE
                    ELSE CAST(floor(abs(c_acctbal)) AS DOUBLE) * 12 END AS annual_income,
               CAST(c_custkey % 900 AS DOUBLE) AS monthly_expenses,
               CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(c_custkey % 5000 AS DOUBLE) END
                   AS savings_balance,
               CASE WHEN c_custkey % 43 = 0 THEN 'Infinity'::DOUBLE
                    ELSE CAST(c_custkey % 700 AS DOUBLE) END AS checking_balance,
               CASE WHEN c_custkey % 20 = 0 THEN 0.0::DOUBLE
                    ELSE CAST(c_custkey % 3000 AS DOUBLE) END AS credit_card_balance,
               CASE WHEN c_custkey % 7 = 0 THEN 0.0::DOUBLE ELSE 5000.0::DOUBLE END
                   AS credit_card_limit,
               CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 300 + c_custkey % 550 END
                   AS credit_score,
               CAST(c_custkey % 40 AS DOUBLE) AS employment_length_years,
               {_CUSTOMER_MONTH} AS snapshot_date
        FROM customer""",
    "v_pred": """
        SELECT 'CUS_' || user_id AS Customer_ID, 'LOAN_' || event_id AS loan_id,
               CAST(ts AS DATE) AS snapshot_date, value / 500.0::DOUBLE AS prediction_probability,
               CAST(value / 500.0::DOUBLE >= 0.1::DOUBLE AS INTEGER) AS prediction_binary,
               CAST(event_type = 'error' AS INTEGER) AS actual_label, event_id, user_id
        FROM events""",
    "v_pred_edge": """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
               l_discount * 10.0::DOUBLE AS prediction_probability
        FROM lineitem""",
    "v_feat": """
        SELECT 'CUS_' || p_partkey AS user_id,
               CAST(DATE '2023-01-01' + to_months(CAST(p_partkey % 24 AS INTEGER)) AS DATE)
                   AS snapshot_date,
               CAST(p_size AS DOUBLE) AS fe_size, CAST(floor(p_retailprice) AS DOUBLE) AS fe_price,
               CAST(n_lines AS DOUBLE) AS fe_lines, quantity AS fe_quantity,
               1.0::DOUBLE AS fe_const, CAST(p_size * 2 + 1 AS DOUBLE) AS fe_size_copy,
               CASE WHEN p_partkey % 9 = 0 THEN 'junk' WHEN p_partkey % 10 = 0 THEN NULL
                    WHEN p_partkey % 13 = 0 THEN '5d' ELSE CAST(p_partkey % 50 AS VARCHAR) END AS fe_text,
               CAST(p_partkey % 90 AS INTEGER) AS dpd, CAST(p_partkey % 11 AS INTEGER) AS mob,
               CAST(p_partkey % 1000 AS DOUBLE) AS balance, CAST(p_size % 2 AS INTEGER) AS label
        FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n_lines, sum(l_quantity) AS quantity
                             FROM lineitem GROUP BY 1) ON p_partkey = l_partkey""",
    "v_feat_num": """
        SELECT user_id, snapshot_date, label, fe_size, fe_price, coalesce(fe_lines, 0) AS fe_lines,
               coalesce(fe_quantity, 0) AS fe_quantity, fe_const, fe_size_copy,
               coalesce(TRY_CAST(fe_text AS DOUBLE), 0) AS fe_text
        FROM v_feat""",
    "v_vec": """
        SELECT vec_id AS id, 'CUS_' || vec_id AS Customer_ID,
               CAST(DATE '2023-01-01' + to_months(CAST(vec_id % 24 AS INTEGER)) AS DATE)
                   AS snapshot_date,
               CAST(embedding AS DOUBLE[]) AS features, CAST(label < 2 AS INTEGER) AS label
        FROM embeddings""",
    # Exact AUC per snapshot: distinct scores first, then the running count of
    # the negatives scored lower.
    "v_auc": """
        SELECT snapshot_date, sum(pos) AS n_pos, sum(neg) AS n_neg,
               sum(CAST(pos AS DOUBLE) * (below + 0.5::DOUBLE * neg))
                   / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
        FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY snapshot_date ORDER BY score
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT snapshot_date, prediction_probability AS score,
                           sum(actual_label) AS pos, sum(1 - actual_label) AS neg
                    FROM v_pred GROUP BY 1, 2))
        GROUP BY 1""",
    "v_cells": """
        SELECT snapshot_date,
               count(*) FILTER (actual_label = 0 AND prediction_binary = 0) AS tn,
               count(*) FILTER (actual_label = 0 AND prediction_binary = 1) AS fp,
               count(*) FILTER (actual_label = 1 AND prediction_binary = 0) AS fn,
               count(*) FILTER (actual_label = 1 AND prediction_binary = 1) AS tp
        FROM v_pred GROUP BY 1""",
    "v_performance": """
        SELECT c.snapshot_date, tn + fp + fn + tp AS num_samples,
               (fn + tp)::DOUBLE / (tn + fp + fn + tp) AS actual_default_rate,
               (fp + tp)::DOUBLE / (tn + fp + fn + tp) AS predicted_default_rate, auc,
               CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS "precision",
               CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                    ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn) END AS f1, tn, fp, fn, tp
        FROM v_cells c JOIN v_auc a ON c.snapshot_date = a.snapshot_date
        WHERE tp + fn > 0 AND tn + fp > 0""",
}


def histogram_sql(view: str, group: str = "snapshot_date") -> str:
    """(group, bin, n_rows) with every bin present, edges as multiples of 0.1."""
    edges = ", ".join(f"({i}, {i * 0.1!r}::DOUBLE, {1.0 if i == 9 else (i + 1) * 0.1!r}::DOUBLE)"
                      for i in range(10))
    return f"""
        SELECT d.{group}, b.bin, d.n AS num_samples,
               (SELECT count(*) FROM {view} v WHERE v.{group} = d.{group}
                  AND v.prediction_probability >= b.lo
                  AND (v.prediction_probability < b.hi
                       OR (b.bin = 9 AND v.prediction_probability <= b.hi))) AS n_rows
        FROM (SELECT {group}, count(*) AS n FROM {view} GROUP BY 1) d
             CROSS JOIN (VALUES {edges}) b(bin, lo, hi)"""


def psi_sql(histogram: str, baseline: str, skip_baseline: bool = False) -> str:
    """PSI per snapshot from a histogram view; falls back to the earliest snapshot."""
    share = "CAST({t}.n_rows AS DOUBLE) / CAST({t}.num_samples AS DOUBLE) + 1e-10"
    a, e = share.format(t="h"), share.format(t="b")
    chosen = f"""(SELECT coalesce(max(CASE WHEN snapshot_date = DATE '{baseline}'
                                           THEN snapshot_date END), min(snapshot_date))
                  FROM {histogram})"""
    keep = f"WHERE h.snapshot_date <> {chosen}" if skip_baseline else (
        f"WHERE h.snapshot_date <> {chosen} OR h.snapshot_date = DATE '{baseline}'")
    return f"""
        SELECT snapshot_date, psi,
               CASE WHEN psi >= 0.2 THEN 'major_drift' WHEN psi >= 0.1 THEN 'minor_drift'
                    ELSE 'stable' END AS drift_status, num_samples
        FROM (SELECT h.snapshot_date, h.num_samples,
                     sum((({a}) - ({e})) * ln(({a}) / ({e}))) AS psi
              FROM {histogram} h JOIN {histogram} b
                   ON b.bin = h.bin AND b.snapshot_date = {chosen}
              {keep}
              GROUP BY 1, 2)"""


VIEW_SQL["v_hist"] = histogram_sql("v_pred")
VIEW_SQL["v_hist_edge"] = histogram_sql("v_pred_edge")
VIEW_SQL["v_psi"] = psi_sql("v_hist", "2024-01-10")

# The monitoring views once more over the predictions that have an actual.
VIEW_SQL["m_pred"] = """
        SELECT p.* FROM v_pred p
        JOIN events e ON e.event_id = p.event_id AND e.event_type <> 'signup'"""
for _name in ("auc", "cells", "performance", "hist", "psi"):
    VIEW_SQL[f"m_{_name}"] = re.sub(
        r"\bv_(pred|auc|cells|performance|hist)\b", r"m_\1", VIEW_SQL[f"v_{_name}"]
    )


def with_views(body: str) -> str:
    """Prefix the query with the views it names, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in VIEW_SQL:
            if re.search(rf"\b{name}\b", text) and name not in ordered:
                visit(VIEW_SQL[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    views = ",\n".join(f"{name} AS ({VIEW_SQL[name]})" for name in ordered)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
