"""Loan snapshots, arrears, labels, windows and customer loan features."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import views
from querybook.registry import query
from querybook.views import day_text
from vintagemart import schemas
from vintagemart.functions import loans as loan_functions
from vintagemart.functions.dates import TrainingWindows, month_spine_of
from vintagemart.operators import aggregates, columns, snapshots
from vintagemart.plans import medallion

SNAPSHOT = "1998-06-01"
CUTOFF = "1999-01-01"
TRAIN_DATE = "1999-09-01"


@query(
    "bronze_snapshot_extract",
    """SELECT loan_id, Customer_ID, installment_num, CAST(loan_amt AS DOUBLE) AS loan_amt,
              CAST(snapshot_date AS VARCHAR) AS snapshot_date
       FROM v_loan WHERE snapshot_date = DATE '1998-06-01'""",
)
def bronze_snapshot_extract(spark, sf_dir):
    df = snapshots.snapshot_extract(views.loan(spark, sf_dir), SNAPSHOT)
    return day_text(
        df.select(
            "loan_id",
            "Customer_ID",
            "installment_num",
            F.col("loan_amt").cast("double").alias("loan_amt"),
            "snapshot_date",
        ),
        "snapshot_date",
    )


_ENFORCED = """
    SELECT loan_id, Customer_ID, CAST(loan_start_date AS VARCHAR) AS loan_start_date, tenure,
           CASE WHEN loan_key % 17 = 0 OR loan_key % 19 = 0 THEN NULL
                ELSE installment_num END AS installment_num,
           CASE WHEN loan_key % 17 = 0 OR loan_key % 19 = 0 THEN NULL
                ELSE CAST(loan_amt AS DOUBLE) END AS loan_amt,
           CASE WHEN loan_key % 17 = 0 OR loan_key % 19 = 0 THEN NULL
                ELSE CAST(due_amt AS DOUBLE) END AS due_amt,
           CAST(overdue_amt AS DOUBLE) AS overdue_amt,
           CAST(snapshot_date AS VARCHAR) AS snapshot_date
    FROM v_loan"""


@query("enforce_schema", _ENFORCED)
def enforce_schema(spark, sf_dir):
    typed = columns.enforce_schema(views.loan_text(spark, sf_dir), schemas.LOAN_DAILY)
    amounts = {
        c: F.col(c).cast("double") for c in ("loan_amt", "due_amt", "overdue_amt")
    }
    return day_text(
        typed.withColumns(amounts).drop("paid_amt", "balance"), "loan_start_date", "snapshot_date"
    )


@query(
    "silver_loan_dpd",
    """SELECT loan_id, mob, installments_missed,
              CAST(first_missed_date AS VARCHAR) AS first_missed_date, dpd,
              CAST(snapshot_date AS VARCHAR) AS snapshot_date
       FROM v_silver_loan""",
)
def silver_loan_dpd(spark, sf_dir):
    df = views.silver_loan(spark, sf_dir).select(
        "loan_id", "mob", "installments_missed", "first_missed_date", "dpd", "snapshot_date"
    )
    return day_text(df, "first_missed_date", "snapshot_date")


@query(
    "silver_loan_dpd_unguarded",
    """SELECT loan_id, installments_missed, CAST(first_missed_date AS VARCHAR) AS first_missed_date,
              CASE WHEN overdue_amt > 0
                   THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER)
                   ELSE 0 END AS dpd,
              CASE WHEN loan_key % 7 = 0 THEN 0 ELSE paid_amt END AS paid_amt,
              CASE WHEN loan_key % 9 = 0 THEN 0 ELSE balance END AS balance
       FROM (SELECT *, CASE WHEN installments_missed > 0
                            THEN CAST(snapshot_date - to_months(installments_missed) AS DATE)
                            END AS first_missed_date
             FROM (SELECT loan_id, loan_key, snapshot_date, overdue_amt, paid_amt, balance,
                          coalesce(CAST(ceil(CAST(overdue_amt AS DOUBLE)
                              / nullif(CAST(due_amt AS DOUBLE), 0)) AS INTEGER), 0)
                              AS installments_missed
                   FROM v_loan))""",
)
def silver_loan_dpd_unguarded(spark, sf_dir):
    """Amounts that are missing are 0 in the whole frame."""
    key = F.regexp_extract("loan_id", "[0-9]+", 0).cast("bigint")
    raw = views.loan(spark, sf_dir).withColumns(
        {
            "paid_amt": F.when(key % 7 != 0, F.col("paid_amt")),
            "balance": F.when(key % 9 != 0, F.col("balance")),
        }
    )
    df = snapshots.loan_arrears(raw, guard_zero_due=False)
    return day_text(
        df.select("loan_id", "installments_missed", "first_missed_date", "dpd", "paid_amt", "balance"),
        "first_missed_date",
    )


@query(
    "gold_label_store",
    """SELECT loan_id, Customer_ID, label, label_def,
              CAST(snapshot_date AS VARCHAR) AS snapshot_date
       FROM v_labels""",
)
def gold_label_store(spark, sf_dir):
    return day_text(snapshots.label_store(views.silver_loan(spark, sf_dir)), "snapshot_date")


@query(
    "bad_rate_by_mob",
    """SELECT mob, avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bad_rate, count(*) AS n_rows
       FROM v_silver_loan WHERE loan_start_date < DATE '1999-01-01' GROUP BY mob""",
)
def bad_rate_by_mob(spark, sf_dir):
    """Flagship: arrears of every loan, flagged and averaged over months on book."""
    started = snapshots.snapshot_range(
        columns.require_columns(views.silver_loan(spark, sf_dir), ["loan_start_date"], "loans"),
        before=CUTOFF,
        date_col="loan_start_date",
    )
    flagged = started.withColumn("dpd_flag", loan_functions.default_flag(F.col("dpd"), 30))
    return aggregates.bad_rate_by(flagged).orderBy("mob")


@query(
    "filter_actual_bads",
    """SELECT loan_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag
       FROM v_silver_loan WHERE installment_num = 10""",
)
def filter_actual_bads(spark, sf_dir):
    df = views.silver_loan(spark, sf_dir).where(F.col("installment_num") == 10)
    return df.select("loan_id", loan_functions.default_flag(F.col("dpd"), 30).alias("dpd_flag"))


@query(
    "temporal_cutoff",
    """SELECT loan_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date
       FROM v_loan WHERE snapshot_date < DATE '1999-01-01'""",
)
def temporal_cutoff(spark, sf_dir):
    df = snapshots.snapshot_range(views.loan(spark, sf_dir), before=CUTOFF)
    return day_text(df.select("loan_id", "snapshot_date"), "snapshot_date")


_WINDOWS = """
    SELECT loan_id, snapshot_date, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
           CASE WHEN snapshot_date < DATE '1999-07-01' THEN 'train_test' ELSE 'oot' END AS split
    FROM v_silver_loan
    WHERE snapshot_date BETWEEN DATE '1998-07-01' AND DATE '1999-08-31'"""


def _windowed(spark, sf_dir):
    labelled = views.silver_loan(spark, sf_dir).withColumn(
        "label", loan_functions.default_flag(F.col("dpd"), 30)
    )
    return snapshots.tag_windows(labelled, TrainingWindows.before(TRAIN_DATE, 12, 2))


@query(
    "oot_window_split",
    f"""SELECT loan_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, split
        FROM ({_WINDOWS})""",
)
def oot_window_split(spark, sf_dir):
    return day_text(
        _windowed(spark, sf_dir).select("loan_id", "snapshot_date", "split"), "snapshot_date"
    )


@query(
    "split_stats",
    # The mean is rounded from whole counts: half-up at the third place.
    f"""SELECT split, count(*) AS n_rows,
               CAST((200 * sum(label) + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0::DOUBLE
                   AS label_mean
        FROM ({_WINDOWS}) GROUP BY split""",
)
def split_stats(spark, sf_dir):
    return aggregates.split_stats(_windowed(spark, sf_dir))


@query(
    "month_spine",
    """SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(o_orderdate)) AS TIMESTAMP),
                                          CAST(max(o_orderdate) AS TIMESTAMP),
                                          INTERVAL 1 MONTH))::DATE AS VARCHAR) AS snapshot_date
       FROM orders""",
)
def month_spine(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return day_text(
        month_spine_of(orders, "o_orderdate").withColumnRenamed("o_orderdate", "snapshot_date"),
        "snapshot_date",
    )


@query(
    "missing_snapshots",
    """SELECT CAST(m AS VARCHAR) AS snapshot_date
       FROM (SELECT unnest(generate_series(CAST(min(snapshot_date) AS TIMESTAMP),
                                           CAST(max(snapshot_date) AS TIMESTAMP),
                                           INTERVAL 1 MONTH))::DATE AS m FROM v_loan)
       WHERE m NOT IN (SELECT snapshot_date FROM v_labels)""",
)
def missing_snapshots(spark, sf_dir):
    """Loan months for which the label store has no snapshot."""
    spine = month_spine_of(views.loan(spark, sf_dir))
    labels = snapshots.label_store(views.silver_loan(spark, sf_dir))
    return day_text(aggregates.missing_snapshots(spine, labels), "snapshot_date")


@query(
    "loan_age_and_payment",
    """SELECT loan_id, loan_age_days, round(monthly_payment, 2) AS monthly_payment, status_clean,
              term_months, interest_rate, loan_amount
       FROM v_silver_user_loan""",
)
def loan_age_and_payment(spark, sf_dir):
    df = snapshots.silver_user_loans(views.user_loan(spark, sf_dir))
    return df.select(
        "loan_id",
        "loan_age_days",
        F.round("monthly_payment", 2).alias("monthly_payment"),
        "status_clean",
        "term_months",
        "interest_rate",
        "loan_amount",
    )


@query(
    "customer_loan_features",
    """SELECT user_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
              avg(loan_amount) AS avg_loan_amount, sum(loan_amount) AS total_loan_amount,
              count(loan_amount) AS num_loans, round(avg(interest_rate), 8) AS avg_interest_rate,
              round(avg(monthly_payment), 2) AS avg_monthly_payment,
              avg(loan_age_days) AS avg_loan_age_days
       FROM v_silver_user_loan GROUP BY ALL""",
)
def customer_loan_features(spark, sf_dir):
    df = aggregates.customer_loan_features(
        snapshots.silver_user_loans(views.user_loan(spark, sf_dir))
    )
    return df.withColumns(
        {
            "avg_interest_rate": F.round("avg_interest_rate", 8),
            "avg_monthly_payment": F.round("avg_monthly_payment", 2),
        }
    )


@query(
    "user_gold_features",
    """SELECT user_id AS Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
              'LOAN_' || split_part(user_id, '_', 2) AS loan_id,
              avg(loan_amount) AS avg_loan_amount, count(loan_amount) AS num_loans,
              coalesce(round(avg(monthly_payment), 2), 0) AS avg_monthly_payment
       FROM v_silver_user_loan GROUP BY ALL""",
)
def user_gold_features(spark, sf_dir):
    gold = medallion.user_gold(snapshots.silver_user_loans(views.user_loan(spark, sf_dir)))
    return gold.select(
        "Customer_ID",
        "snapshot_date",
        "loan_id",
        "avg_loan_amount",
        "num_loans",
        F.round("avg_monthly_payment", 2).alias("avg_monthly_payment"),
    )


@query(
    "derive_loan_id",
    """SELECT user_id, CASE WHEN contains(user_id, '_') THEN 'LOAN_' || split_part(user_id, '_', 2)
                            ELSE 'LOAN_000000' END AS loan_id,
              'LOAN_000000' AS loan_id_without_separator
       FROM v_user_loan GROUP BY user_id""",
)
def derive_loan_id(spark, sf_dir):
    users = views.user_loan(spark, sf_dir).select("user_id").distinct()
    bare = F.regexp_replace("user_id", "_", "")
    return users.select(
        "user_id",
        loan_functions.loan_id_from_customer(F.col("user_id")).alias("loan_id"),
        loan_functions.loan_id_from_customer(bare).alias("loan_id_without_separator"),
    )
