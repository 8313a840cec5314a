"""Scans, sinks, stores, audits and the registry, by round trips through fresh folders."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from querybook import views
from querybook.registry import query
from querybook.views import day_text
from vintagemart import schemas
from vintagemart.operators import aggregates, decisions, drift, evaluation, snapshots
from vintagemart.sources import files, registry, store
from vintagemart.sources.scratch import scratch_path

CUSTOMER_CSV = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_acctbal", DoubleType()),
    ]
)


@query(
    "scan_csv_typed",
    """SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS c_name, c_acctbal
       FROM customer""",
)
def scan_csv_typed(spark, sf_dir):
    """Names with commas and quotes survive the CSV file."""
    path = scratch_path(spark, "csv")
    named = views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name"),
        "c_acctbal",
    )
    files.write_csv(named, path)
    return files.scan_csv(spark, path, CUSTOMER_CSV)


_LOAN_ROWS = """
    SELECT loan_id, Customer_ID, installment_num, CAST(loan_amt AS DOUBLE) AS loan_amt,
           CAST(snapshot_date AS VARCHAR) AS snapshot_date
    FROM v_loan"""


def _loan_rows(df):
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


@query("sink_csv_roundtrip", _LOAN_ROWS)
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "loans-csv")
    files.write_csv(views.loan(spark, sf_dir), path, ["snapshot_date"])
    return _loan_rows(files.scan_csv(spark, path, schemas.LOAN_DAILY))


def _loan_store(spark, sf_dir):
    path = scratch_path(spark, "loans")
    store.write_snapshots(views.loan(spark, sf_dir), path)
    return path


@query("scan_snapshot_pruned", f"{_LOAN_ROWS} WHERE snapshot_date = DATE '1998-06-01'")
def scan_snapshot_pruned(spark, sf_dir):
    return _loan_rows(store.read_snapshot(spark, _loan_store(spark, sf_dir), "1998-06-01"))


@query("store_read_all", _LOAN_ROWS)
def store_read_all(spark, sf_dir):
    path = _loan_store(spark, sf_dir)
    return _loan_rows(store.read_snapshots(spark, path, schema=schemas.LOAN_DAILY))


@query(
    "store_union_by_name",
    """SELECT loan_id, Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date, mob, dpd,
              NULL::INTEGER AS label
       FROM v_silver_loan
       UNION ALL
       SELECT loan_id, Customer_ID, CAST(snapshot_date AS VARCHAR), NULL, NULL, label
       FROM v_labels""",
)
def store_union_by_name(spark, sf_dir):
    silver = views.silver_loan(spark, sf_dir)
    labels = snapshots.label_store(silver).drop("label_def")
    both = store.union_by_name(
        [silver.select("loan_id", "Customer_ID", "snapshot_date", "mob", "dpd"), labels]
    )
    return day_text(both, "snapshot_date")


@query(
    "sink_dynamic_overwrite",
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS n_rows,
              count(*) FILTER (snapshot_date = DATE '1998-06-01') AS n_rewritten
       FROM v_loan GROUP BY 1""",
)
def sink_dynamic_overwrite(spark, sf_dir):
    """One month is written again; the other months keep their files."""
    path = scratch_path(spark, "loans")
    loans = views.loan(spark, sf_dir).withColumn("run", F.lit(1))
    store.write_snapshots(loans, path)
    month = snapshots.snapshot_extract(loans, "1998-06-01").withColumn("run", F.lit(2))
    store.write_snapshots(month, path)
    return day_text(
        store.read_snapshots(spark, path)
        .groupBy("snapshot_date")
        .agg(F.count("*").alias("n_rows"), F.count_if(F.col("run") == 2).alias("n_rewritten")),
        "snapshot_date",
    )


@query(
    "layer_row_audit",
    """SELECT 'silver' AS layer, 'loan_daily' AS table_name,
              CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS n_rows
       FROM v_silver_loan GROUP BY 3
       UNION ALL
       SELECT 'gold', 'label_store', CAST(snapshot_date AS VARCHAR), count(*) FROM v_labels
       GROUP BY 3
       UNION ALL
       SELECT 'bronze', 'customer', NULL, count(*) FROM customer""",
)
def layer_row_audit(spark, sf_dir):
    silver = views.silver_loan(spark, sf_dir)
    audit = aggregates.row_audit(
        {
            ("bronze", "customer"): views.table(spark, sf_dir, "customer"),
            ("silver", "loan_daily"): silver,
            ("gold", "label_store"): snapshots.label_store(silver),
        }
    )
    return day_text(audit, "snapshot_date")


@query(
    "scan_files_recursive",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT loan_id) AS n_loans FROM v_loan",
)
def scan_files_recursive(spark, sf_dir):
    """All files of a partitioned table, read without knowing its layout."""
    found = store.scan_files(spark, _loan_store(spark, sf_dir))
    per_loan = found.groupBy("loan_id").agg(F.count("*").alias("n"))
    return per_loan.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_loans"))


REPORT = StructType(
    [
        StructField(c, DoubleType())
        for c in ("avg_auc", "avg_precision", "avg_recall", "avg_f1", "max_psi", "avg_psi")
    ]
)


@query(
    "json_report_roundtrip",
    """SELECT round((SELECT avg(auc) FROM v_performance), 8) AS avg_auc,
              round((SELECT max(psi) FROM v_psi), 8) AS max_psi""",
)
def json_report_roundtrip(spark, sf_dir):
    scored = views.prediction(spark, sf_dir)
    summary = decisions.monitoring_summary(
        evaluation.performance_by_group(scored), drift.psi_by_snapshot(scored, "2024-01-10")
    )
    path = scratch_path(spark, "report")
    files.write_json_record(summary, path)
    report = files.scan_json(spark, path, REPORT)
    return report.select(F.round("avg_auc", 8).alias("avg_auc"), F.round("max_psi", 8).alias("max_psi"))


def _runs(spark, sf_dir):
    """Orders as training runs: name, date, path and a metric."""
    key = F.col("o_orderkey")
    null = F.lit(None)
    auc = ((key * 7919) % 1000).cast("double") / F.lit(1000.0)
    row = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model_name"),
        F.concat(F.lit("run_"), key.cast("string")).alias("model_path"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.struct(
            auc.alias("auc"),
            null.cast("double").alias("precision"),
            null.cast("double").alias("recall"),
            null.cast("double").alias("f1"),
            null.cast("array<array<bigint>>").alias("confusion_matrix"),
        ).alias("metrics"),
        F.array(F.lit("fe_1"), F.lit("fe_2")).alias("feature_columns"),
        F.lit(2).alias("n_features"),
    )
    rest = [f for f in schemas.MODEL_REGISTRY.fields if f.name not in row.columns]
    return row.select("*", *[null.cast(f.dataType).alias(f.name) for f in rest]).select(
        schemas.MODEL_REGISTRY.names
    )


@query(
    "registry_latest_model",
    """SELECT model_name, model_path, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS trained_on, auc
       FROM (SELECT o_orderpriority AS model_name, 'run_' || o_orderkey AS model_path, o_orderdate,
                    ((o_orderkey * 7919) % 1000)::DOUBLE / 1000.0::DOUBLE AS auc,
                    row_number() OVER (PARTITION BY o_orderpriority
                                       ORDER BY o_orderdate DESC, 'run_' || o_orderkey DESC) AS rn
             FROM orders) WHERE rn = 1""",
)
def registry_latest_model(spark, sf_dir):
    newest = registry.latest(_runs(spark, sf_dir), ["model_name"])
    return newest.select(
        "model_name",
        "model_path",
        F.date_format("timestamp", "yyyy-MM-dd").alias("trained_on"),
        F.col("metrics.auc").alias("auc"),
    )


@query(
    "registry_append",
    """SELECT o_orderpriority AS model_name, 2 * count(*) AS n_runs,
              CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS latest
       FROM orders GROUP BY 1""",
)
def registry_append(spark, sf_dir):
    """Runs registered twice are both kept."""
    path = scratch_path(spark, "registry")
    runs = _runs(spark, sf_dir)
    registry.register(runs, path)
    registry.register(runs, path)
    rows = registry.read_registry(spark, path)
    return rows.groupBy("model_name").agg(
        F.count("*").alias("n_runs"),
        F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("latest"),
    )


# Three layouts of the same extract: names, and which customers are in it.
_LAYOUTS = {
    0: ["c_custkey", "c_name", "c_acctbal"],
    1: ["c_acctbal", "extra", "c_custkey", "c_name"],
    2: ["c_name", "c_custkey", "c_acctbal"],
}


def _extract_lines(spark, sf_dir):
    """Lines of CSV files, a header first in each: every 17th has a field too many, every
    19th one too few, and every 23rd a balance that is no number."""
    key = F.col("c_custkey")
    balance = F.when(key % 23 == 0, F.lit("n/a")).otherwise(key.cast("string"))
    field = {
        "c_custkey": key.cast("string"),
        "c_name": F.concat(F.lit('"'), "c_name", F.lit(', ""esq"""')),
        "c_acctbal": balance,
        "extra": F.lit("x"),
    }
    more = F.when(key % 17 == 0, ",more").otherwise("")
    customers = views.table(spark, sf_dir, "customer")
    parts = []
    for layout, names in _LAYOUTS.items():
        whole = F.concat(F.concat_ws(",", *[field[n] for n in names]), more)
        short = F.concat_ws(",", *[field[n] for n in names[:-1]])
        line = F.when((key % 19 == 0) & (key % 17 != 0), short).otherwise(whole)
        own = customers.where(key % 3 == layout)
        parts.append(own.select((key % 6).alias("file"), key.alias("place"), line.alias("line")))
        # Every customer's file gets its header from the rows themselves.
        files_of = own.select((key % 6).alias("file")).distinct()
        parts.append(files_of.select("file", F.lit(-1).cast("bigint").alias("place"), F.lit(",".join(names)).alias("line")))
    return store.union_by_name(parts)


@query(
    "scan_csv_rejects",
    """WITH c AS (SELECT *, c_custkey % 3 AS layout,
                         CASE WHEN c_custkey % 17 = 0 OR c_custkey % 19 = 0 THEN 'number of fields'
                              WHEN c_custkey % 23 = 0 THEN 'c_acctbal: n/a' END AS reason FROM customer)
       SELECT 'row' AS kind, layout, c_custkey, c_name || ', "esq"' AS c_name,
              c_custkey::DOUBLE AS c_acctbal, NULL AS reason, 1 AS n
       FROM c WHERE reason IS NULL
       UNION ALL SELECT 'reject', layout, NULL, NULL, NULL, reason, count(*) FROM c WHERE reason IS NOT NULL GROUP BY 2, 6""",
)
def scan_csv_rejects(spark, sf_dir):
    """Files with columns in three orders, read by name; bad lines counted by file and reason."""
    path = scratch_path(spark, "extracts")
    lines = _extract_lines(spark, sf_dir)
    ordered = lines.repartition("file").sortWithinPartitions("file", "place")
    ordered.select("file", "line").write.partitionBy("file").text(path)
    paths = files.matching(spark, f"{path}/file=*/*.txt")
    rows, rejects = files.scan_csv_checked(spark, paths, CUSTOMER_CSV)
    file = F.regexp_extract("file", r"/file=(\d+)/", 1).cast("bigint")
    counted = rejects.groupBy((file % 3).alias("layout"), "reason").agg(F.count("*").alias("n"))
    kept = rows.select(
        F.lit("row").alias("kind"),
        (F.col("c_custkey") % 3).alias("layout"),
        *CUSTOMER_CSV.names,
        F.lit(None).cast("string").alias("reason"),
        F.lit(1).cast("bigint").alias("n"),
    )
    told = counted.select(F.lit("reject").alias("kind"), "layout", "reason", "n")
    return kept.unionByName(told, allowMissingColumns=True)
