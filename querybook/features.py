"""Click aggregates, joins and feature-frame preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import views
from querybook.registry import query
from querybook.views import day_text
from vintagemart.operators import aggregates, columns, correlation, joins, snapshots
from vintagemart.operators.scaling import StandardScaling

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
NUMERIC = ("fe_size", "fe_price", "fe_lines", "fe_quantity", "fe_const", "fe_size_copy", "fe_text")


@query(
    "silver_clickstream_counts",
    """SELECT Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
              count(*) AS total_clicks
       FROM v_click GROUP BY ALL""",
)
def silver_clickstream_counts(spark, sf_dir):
    return day_text(snapshots.silver_clicks(views.click(spark, sf_dir)), "snapshot_date")


@query(
    "clickstream_breakdown",
    """SELECT Customer_ID, event_type, count(event_id) AS n_ids, count(*) AS n_events
       FROM v_click GROUP BY ALL""",
)
def clickstream_breakdown(spark, sf_dir):
    return aggregates.event_breakdown_long(
        views.click(spark, sf_dir), ["Customer_ID"], event_id="event_id"
    )


@query(
    "clickstream_breakdown_map",
    """SELECT Customer_ID, count(event_id) AS total_events,
              count(*) FILTER (event_type = 'click') AS n_click,
              count(*) FILTER (event_type = 'error') AS n_error,
              CAST(count(DISTINCT event_type) AS INTEGER) AS n_types
       FROM v_click GROUP BY ALL""",
)
def clickstream_breakdown_map(spark, sf_dir):
    """The map itself, read back by key because the engines print maps differently."""
    df = aggregates.event_breakdown(views.click(spark, sf_dir), ["Customer_ID"], event_id="event_id")
    of = lambda t: F.coalesce(F.try_element_at("event_breakdown", F.lit(t)), F.lit(0))
    return df.select(
        "Customer_ID",
        "total_events",
        of("click").alias("n_click"),
        of("error").alias("n_error"),
        F.size("event_breakdown").alias("n_types"),
    )


@query(
    "clickstream_pivot",
    "SELECT Customer_ID, count(*) AS total_events, "
    + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in EVENT_TYPES)
    + " FROM v_click GROUP BY ALL",
)
def clickstream_pivot(spark, sf_dir):
    return aggregates.event_pivot(views.click(spark, sf_dir), EVENT_TYPES, ["Customer_ID"])


@query(
    "gold_feature_store",
    """SELECT l.loan_id, l.Customer_ID, CAST(l.snapshot_date AS VARCHAR) AS snapshot_date,
              mob, dpd, fe_1 AS total_clicks, clean_age AS Age, Age_Group, Occupation,
              CAST(clean_income AS DOUBLE) AS Annual_Income, Credit_Mix_Score,
              Credit_History_Months,
              CASE WHEN dpd >= 30 AND mob >= 6 THEN 1 ELSE 0 END AS label_default_30dpd
       FROM v_silver_loan l
       LEFT JOIN v_click_month c
              ON l.Customer_ID = c.Customer_ID AND l.snapshot_date = c.snapshot_date
       LEFT JOIN v_clean_age a
              ON l.Customer_ID = a.Customer_ID AND l.snapshot_date = a.snapshot_date
       LEFT JOIN v_silver_financials f
              ON l.Customer_ID = f.Customer_ID AND l.snapshot_date = f.snapshot_date""",
)
def gold_feature_store(spark, sf_dir):
    clicks = views.click_month(spark, sf_dir).select(
        "Customer_ID", "snapshot_date", F.col("fe_1").alias("total_clicks")
    )
    wide = joins.gold_feature_join(
        views.silver_loan(spark, sf_dir),
        clicks,
        snapshots.silver_attributes(views.attributes(spark, sf_dir), drop_personal=True),
        snapshots.silver_financials(views.financials(spark, sf_dir)),
    )
    return day_text(
        snapshots.add_row_label(wide).select(
            "loan_id",
            "Customer_ID",
            "snapshot_date",
            "mob",
            "dpd",
            "total_clicks",
            "Age",
            "Age_Group",
            "Occupation",
            F.col("Annual_Income").cast("double").alias("Annual_Income"),
            "Credit_Mix_Score",
            "Credit_History_Months",
            "label_default_30dpd",
        ),
        "snapshot_date",
    )


@query(
    "training_set_join",
    """SELECT l.loan_id, l.Customer_ID, CAST(l.snapshot_date AS VARCHAR) AS snapshot_date,
              label, label_def, fe_1, fe_2, fe_3
       FROM v_labels l LEFT JOIN v_click_month c
            ON l.Customer_ID = c.Customer_ID AND l.snapshot_date = c.snapshot_date""",
)
def training_set_join(spark, sf_dir):
    labels = snapshots.label_store(views.silver_loan(spark, sf_dir))
    return day_text(
        joins.training_set_join(labels, views.click_month(spark, sf_dir)), "snapshot_date"
    )


@query(
    "select_features_by_prefix",
    """SELECT user_id, fe_size, fe_price, fe_lines, fe_quantity, fe_const, fe_size_copy, fe_text
       FROM v_feat""",
)
def select_features_by_prefix(spark, sf_dir):
    return columns.select_by_prefix(views.feature(spark, sf_dir), "fe_", keep=["user_id"])


@query(
    "drop_leakage_columns",
    "SELECT fe_size, fe_price, fe_lines, fe_quantity, fe_const, fe_size_copy, fe_text FROM v_feat",
)
def drop_leakage_columns(spark, sf_dir):
    return columns.drop_leakage(views.feature(spark, sf_dir), "label")


def _with_other_types(spark, sf_dir):
    """Features that are no numbers: a date, an array, a map; and a flag."""
    return views.feature(spark, sf_dir).withColumns(
        {
            "fe_day": F.col("snapshot_date"),
            "fe_tags": F.array("fe_text"),
            "fe_map": F.create_map(F.lit("size"), F.col("fe_size")),
            "fe_flag": F.col("label") == 1,
        }
    )


@query(
    "align_features_to_model",
    """SELECT user_id, fe_price, 0.0::DOUBLE AS fe_absent, 0.0::DOUBLE AS fe_day, fe_text,
              0.0::DOUBLE AS fe_tags, fe_lines
       FROM v_feat_num""",
)
def align_features_to_model(spark, sf_dir):
    names = ["fe_price", "fe_absent", "fe_day", "fe_text", "fe_tags", "fe_lines"]
    return columns.align_features(_with_other_types(spark, sf_dir), names, ["user_id"])


@query(
    "coerce_numeric_features",
    """SELECT user_id, fe_size, fe_price, fe_lines, fe_quantity, fe_const, fe_size_copy, fe_text,
              0.0::DOUBLE AS fe_day, 0.0::DOUBLE AS fe_tags, 0.0::DOUBLE AS fe_map,
              CAST(label AS DOUBLE) AS fe_flag
       FROM v_feat_num""",
)
def coerce_numeric_features(spark, sf_dir):
    names = (*NUMERIC, "fe_day", "fe_tags", "fe_map", "fe_flag")
    df = columns.coerce_numeric(_with_other_types(spark, sf_dir), names)
    return df.select("user_id", *names)


def _numeric(spark, sf_dir):
    return columns.coerce_numeric(views.feature(spark, sf_dir), NUMERIC)


@query(
    "feature_profile",
    """SELECT feature, count(*) AS n_rows, count(DISTINCT value) AS n_distinct,
              min(value) AS min_value, max(value) AS max_value,
              count(DISTINCT value) <= 1 AS is_constant
       FROM (UNPIVOT (SELECT fe_size, fe_price, fe_lines, fe_quantity, fe_const, fe_size_copy,
                             fe_text FROM v_feat_num)
             ON fe_size, fe_price, fe_lines, fe_quantity, fe_const, fe_size_copy, fe_text
             INTO NAME feature VALUE value)
       GROUP BY feature""",
)
def feature_profile(spark, sf_dir):
    df = columns.feature_profile(_numeric(spark, sf_dir), NUMERIC)
    return df.withColumn("n_rows", F.col("n_rows").cast("bigint"))


_PAIRS = [(a, b) for j, b in enumerate(NUMERIC) for a in NUMERIC[:j]]


def _corr_sql() -> str:
    parts = []
    for a, b in _PAIRS:
        if "fe_const" in (a, b):
            value = "max(NULL::DOUBLE)"
        else:
            value = f"round(corr({a}, {b}), 6)"
        parts.append(f"SELECT '{a}' AS earlier, '{b}' AS later, {value} AS corr FROM v_feat_num")
    return " UNION ALL ".join(parts)


@query("feature_correlation_pairs", _corr_sql())
def feature_correlation_pairs(spark, sf_dir):
    df = columns.correlation_pairs(_numeric(spark, sf_dir), NUMERIC)
    return df.withColumn("corr", F.round("corr", 6))


@query("correlation_tiled", _corr_sql())
def correlation_tiled(spark, sf_dir):
    """The same pairs from summed tiles of cross products."""
    df = correlation.tiled_correlations(_numeric(spark, sf_dir), NUMERIC)
    return df.withColumn("corr", F.round("corr", 6))


@query(
    "selected_features",
    """SELECT feature FROM (VALUES ('fe_size'), ('fe_price'), ('fe_lines'), ('fe_quantity'),
                                   ('fe_text')) kept(feature)
       WHERE (SELECT max(abs(c)) FROM (SELECT unnest([
                  corr(fe_size, fe_price), corr(fe_size, fe_lines), corr(fe_price, fe_lines),
                  corr(fe_size, fe_quantity), corr(fe_price, fe_quantity),
                  corr(fe_size, fe_text), corr(fe_price, fe_text), corr(fe_lines, fe_text),
                  corr(fe_quantity, fe_text)]) AS c FROM v_feat_num)) <= 0.95
         AND (feature <> 'fe_quantity'
              OR (SELECT abs(corr(fe_lines, fe_quantity)) FROM v_feat_num) <= 0.95)""",
)
def selected_features(spark, sf_dir):
    """Constant and highly correlated features dropped, as before training."""
    df = _numeric(spark, sf_dir)
    constant = columns.constant_features(df, NUMERIC)
    varying = [c for c in NUMERIC if c not in constant]
    correlated = columns.correlated_features(df, varying)
    kept = [c for c in varying if c not in correlated]
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query(
    "standard_scale",
    """SELECT user_id, """
    + ", ".join(
        f"round((f.{c} - (SELECT avg({c}) FROM v_feat_num WHERE snapshot_date < DATE '2024-06-01'))"
        f" / coalesce(nullif((SELECT stddev_pop({c}) FROM v_feat_num"
        f" WHERE snapshot_date < DATE '2024-06-01'), 0), 1), 6) AS {c}"
        for c in ("fe_size", "fe_price", "fe_lines", "fe_const")
    )
    + " FROM v_feat_num f",
)
def standard_scale(spark, sf_dir):
    """Fitted on the months before the cut-off, applied to all months."""
    names = ("fe_size", "fe_price", "fe_lines", "fe_const")
    df = _numeric(spark, sf_dir)
    scaling = StandardScaling.fit(snapshots.snapshot_range(df, before="2024-06-01"), names)
    return scaling.apply(df).select("user_id", *[F.round(c, 6).alias(c) for c in names])
