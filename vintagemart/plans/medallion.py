"""Raw extracts -> bronze -> silver -> gold, all months in one job per table.

A range of months is one filter on the partition column, so re-running a month
and backfilling years are the same call.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from vintagemart import schemas
from vintagemart.functions.dates import month_spine
from vintagemart.functions.loans import loan_id_from_customer
from vintagemart.operators import aggregates, joins, snapshots
from vintagemart.operators.columns import fill_numeric_nulls
from vintagemart.plans.lake import Lake
from vintagemart.sources import files, store

# Names of the raw extracts.
RAW_FILES = {
    "loan_daily": "lms_loan_daily.csv",
    "clickstream": "feature_clickstream.csv",
    "attributes": "features_attributes.csv",
    "financials": "features_financials.csv",
}
TABLES = tuple(RAW_FILES)

# File prefixes of the monthly user-schema extracts.
USER_FILES = {
    "loan_daily": ("lms", schemas.USER_LOANS),
    "clickstream": ("clickstream", schemas.USER_CLICKS),
    "attributes": ("attributes", schemas.USER_ATTRIBUTES),
    "financials": ("financials", schemas.USER_FINANCIALS),
}

Day = date | str | None


def _raw_schema(spark: SparkSession, table: str, path: str) -> StructType:
    """Every raw column as text, in file order, but for the snapshot date."""
    known = {
        "loan_daily": schemas.LOAN_DAILY,
        "attributes": schemas.ATTRIBUTES_RAW,
        "financials": schemas.FINANCIALS_RAW,
    }
    names = files.csv_columns(spark, path)
    if table in known:
        unknown = set(known[table].names) - set(names)
        if unknown:
            raise ValueError(f"{path} has no column {sorted(unknown)}")
    text = schemas.raw_text(StructType([StructField(n, DateType()) for n in names]))
    return StructType(
        [StructField("snapshot_date", DateType()) if f.name == "snapshot_date" else f for f in text]
    )


def load_bronze(
    spark: SparkSession,
    raw_root: str,
    lake: Lake,
    first: Day = None,
    last: Day = None,
    tables: tuple[str, ...] = TABLES,
) -> None:
    """Each raw extract is read once and lands partitioned by snapshot."""
    for table in tables:
        path = f"{raw_root.rstrip('/')}/{RAW_FILES[table]}"
        raw = files.scan_csv(spark, path, _raw_schema(spark, table, path))
        if "snapshot_date" in raw.columns:
            store.write_snapshots(
                snapshots.snapshot_range(raw, first, last), lake.path("bronze", table)
            )
        else:
            raw.write.mode("overwrite").parquet(lake.path("bronze", table))


def build_silver(
    spark: SparkSession,
    lake: Lake,
    first: Day = None,
    last: Day = None,
    drop_personal: bool = True,
) -> None:
    def bronze(table: str) -> DataFrame:
        return store.read_snapshots(spark, lake.path("bronze", table), first, last)

    silver = {
        "loan_daily": snapshots.silver_loans(bronze("loan_daily")),
        "clickstream": snapshots.silver_clicks(bronze("clickstream")),
        "attributes": snapshots.silver_attributes(
            bronze("attributes"), drop_personal=drop_personal
        ),
        "financials": snapshots.silver_financials(bronze("financials")),
    }
    for table, df in silver.items():
        store.write_snapshots(df, lake.path("silver", table))


def build_gold(
    spark: SparkSession,
    lake: Lake,
    first: Day = None,
    last: Day = None,
    dpd: int = 30,
    mob: int = 6,
) -> None:
    def silver(table: str) -> DataFrame:
        return store.read_snapshots(spark, lake.path("silver", table), first, last)

    loans = silver("loan_daily")
    wide = joins.gold_feature_join(
        loans, silver("clickstream"), silver("attributes"), silver("financials")
    )
    store.write_snapshots(
        snapshots.add_row_label(wide, dpd, mob), lake.path("gold", "feature_store")
    )
    store.write_snapshots(
        snapshots.label_store(loans, dpd, mob), lake.path("gold", "label_store")
    )


def audit(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows per layer, table and snapshot, counted from the written files."""
    names = [("bronze", t) for t in TABLES] + [("silver", t) for t in TABLES]
    names += [("gold", "feature_store"), ("gold", "label_store")]
    return aggregates.row_audit(
        {(layer, t): store.read_snapshots(spark, lake.path(layer, t)) for layer, t in names}
    )


def missing_months(
    spark: SparkSession, lake: Lake, layer: str, table: str, first: date | str, last: date | str
) -> DataFrame:
    """Months of the range that the table lacks; the others were processed all the same."""
    stored = store.read_snapshots(spark, lake.path(layer, table), first, last)
    return aggregates.missing_snapshots(month_spine(spark, first, last), stored)


def _store_reports(
    spark: SparkSession,
    lake: Lake,
    counted: DataFrame,
    tables: tuple[str, ...],
    first: Day,
    last: Day,
) -> DataFrame:
    """Store the row audit, and the months of the range that a bronze table lacks.

    Months of an open range can't be missing. Returns the stored audit.
    """
    counted.write.mode("overwrite").parquet(lake.path("audit", "rows"))
    if first and last:
        absent = [
            missing_months(spark, lake, "bronze", t, first, last).withColumn("table_name", F.lit(t))
            for t in tables
        ]
        store.union_by_name(absent).write.mode("overwrite").parquet(
            lake.path("audit", "missing_months")
        )
    return spark.read.parquet(lake.path("audit", "rows"))


def run(
    spark: SparkSession, raw_root: str, lake: Lake, first: Day = None, last: Day = None
) -> DataFrame:
    """All layers; returns the row audit, stored beside the missing months."""
    load_bronze(spark, raw_root, lake, first, last)
    build_silver(spark, lake, first, last)
    build_gold(spark, lake, first, last)
    return _store_reports(spark, lake, audit(spark, lake), TABLES, first, last)


# --- user schema ----------------------------------------------------------


def user_silver(
    loans: DataFrame, clicks: DataFrame, attributes: DataFrame, financials: DataFrame
) -> dict[str, DataFrame]:
    return {
        "loan_daily": snapshots.silver_user_loans(loans),
        "clickstream": aggregates.event_breakdown(
            clicks, ["user_id", "snapshot_date"], event_id="event_id"
        ),
        "attributes": snapshots.silver_user_attributes(attributes),
        "financials": snapshots.silver_user_financials(financials),
    }


def load_user_bronze(
    spark: SparkSession, raw_root: str, lake: Lake, first: Day = None, last: Day = None
) -> None:
    """Monthly parquet extracts, their text dates typed, partitioned by snapshot.

    A month that can't be read is left out and stored by name with the reason; the
    other months go on. A table without any readable month is an error.
    """
    unreadable = []
    for table, (prefix, schema) in USER_FILES.items():
        paths = files.matching(spark, f"{raw_root.rstrip('/')}/{prefix}_*.parquet")
        good, bad = files.readable_parquet(spark, paths, schema)
        unreadable += [(table, path, reason) for path, reason in sorted(bad.items())]
        if not good:
            raise ValueError(f"no readable extract {prefix}_*.parquet in {raw_root}: {bad}")
        raw = spark.read.schema(schema).parquet(*good)
        dated = raw.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
        store.write_snapshots(
            snapshots.snapshot_range(dated, first, last), lake.path("bronze", table)
        )
    report = spark.createDataFrame(unreadable, "table_name string, path string, reason string")
    report.write.mode("overwrite").parquet(lake.path("audit", "unreadable_extracts"))


def run_user(
    spark: SparkSession, raw_root: str, lake: Lake, first: Day = None, last: Day = None
) -> DataFrame:
    """Bronze, silver and gold of the user schema; returns the row audit."""
    load_user_bronze(spark, raw_root, lake, first, last)
    bronze = [
        store.read_snapshots(spark, lake.path("bronze", table), first, last)
        for table in USER_FILES
    ]
    for table, df in user_silver(*bronze).items():
        store.write_snapshots(df, lake.path("silver", table))
    loans = store.read_snapshots(spark, lake.path("silver", "loan_daily"), first, last)
    store.write_snapshots(user_gold(loans), lake.path("gold", "feature_store"))
    names = [(layer, table) for layer in ("bronze", "silver") for table in USER_FILES]
    counted = aggregates.row_audit(
        {
            name: store.read_snapshots(spark, lake.path(*name))
            for name in [*names, ("gold", "feature_store")]
        }
    )
    return _store_reports(spark, lake, counted, tuple(USER_FILES), first, last)


def user_gold(loans_silver: DataFrame) -> DataFrame:
    """Loan features per customer and snapshot, with a derived loan id."""
    features = aggregates.customer_loan_features(loans_silver).withColumnRenamed(
        "user_id", "Customer_ID"
    )
    return fill_numeric_nulls(
        features.withColumn("loan_id", loan_id_from_customer(F.col("Customer_ID")))
    )
