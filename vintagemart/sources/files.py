"""CSV and JSON scans and sinks."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Quoted fields with doubled quotes, as names with commas are written.
CSV_QUOTING = {"header": "true", "quote": '"', "escape": '"'}


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever store it is in."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _hadoop_path(spark, path)
    return bool(system.exists(found))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order."""
    found, system = _hadoop_path(spark, pattern)
    return sorted(str(s.getPath()) for s in system.globStatus(found) or [])


def readable_parquet(
    spark: SparkSession, paths: Sequence[str], schema: StructType
) -> tuple[list[str], dict[str, str]]:
    """The paths whose parquet footer can be read and has the columns of the schema,
    and what is wrong with the others. One small read per path, of footers alone."""
    good, bad = [], {}
    for path in paths:
        try:
            absent = set(schema.names) - set(spark.read.parquet(path).columns)
        except Exception as error:  # whatever a reader says about a broken file
            bad[path] = str(error).strip().splitlines()[0][:300]
            continue
        if absent:
            bad[path] = f"no column {sorted(absent)}"
        else:
            good.append(path)
    return good, bad


def scan_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType
) -> DataFrame:
    """Headed CSV read with a given schema, in one pass.

    Columns are read by position, so a header with other names or another order is an
    error; ``scan_csv_checked`` matches by name. Unreadable fields become null.
    """
    reader = spark.read.schema(schema).options(**CSV_QUOTING).option("enforceSchema", "false")
    return reader.csv(paths)


# Columns that a checked scan adds while it works.
_CORRUPT, _FILE = "__corrupt", "__file"


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The header of each file, in file order. One line of each is read; a file without
    a line has no columns."""
    texts = {}
    for path in paths:
        found, system = _hadoop_path(spark, path)
        stream = system.open(found)
        try:
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            texts[path] = (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            stream.close()
    return {path: tuple(next(csv.reader([text]), [])) for path, text in texts.items()}


def scan_csv_checked(
    spark: SparkSession, paths: Sequence[str], schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of headed CSV files, columns matched by the names in each header.

    Columns may stand in any order; columns that the schema doesn't have are left out,
    and a file that lacks one of the schema's has none of its rows read. ``rows`` has the
    schema's columns, ``rejects`` (file, row, reason): lines with more or fewer fields
    than their header, values that their type can't hold, and one row without text for
    each file with an unfit header. Every line is in exactly one of the two. Empty fields
    are null. Files with the same header are one scan, however many there are.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in csv_headers(spark, paths).items():
        by_header.setdefault(header, []).append(path)
    scans, unfit = [], []
    for header, group in sorted(by_header.items()):
        absent = sorted(set(schema.names) - set(header))
        twice = sorted({n for n in header if n in schema.names and header.count(n) > 1})
        if absent or twice:
            reason = f"no column {absent}" if absent else f"column twice {twice}"
            unfit += [(path, None, reason) for path in group]
        else:
            scans.append(_checked(spark, group, header, schema))
    rejects_schema = "file string, row string, reason string"
    rejects = spark.createDataFrame(unfit, rejects_schema)
    rows = spark.createDataFrame([], schema)
    for scan in scans:
        bad = F.col("__reason").isNotNull()
        rows = rows.unionByName(scan.where(~bad).select(*schema.names))
        found = scan.where(bad).select(F.col(_FILE), F.col("__row"), F.col("__reason"))
        rejects = rejects.union(found)
    return rows, rejects


def _checked(
    spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: StructType
) -> DataFrame:
    """The schema's columns of files with one header, with the line and why it is bad."""
    names = [f"c{i}" for i in range(len(header))]
    text = StructType([StructField(n, StringType()) for n in [*names, _CORRUPT]])
    # Without pruning every line is taken apart whole, so its fields are counted.
    options = {**CSV_QUOTING, "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false"}
    read = spark.read.schema(text).options(**options).option("enforceSchema", "true").csv(paths)
    read = read.select("*", F.col("_metadata.file_path").alias(_FILE))
    place = {n: F.col(names[header.index(n)]) for n in schema.names}
    typed = {f.name: place[f.name].try_cast(f.dataType) for f in schema}
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("number of fields"))
    for f in schema:
        lost = place[f.name].isNotNull() & typed[f.name].isNull()
        reason = reason.when(lost, F.concat(F.lit(f"{f.name}: "), place[f.name]))
    # A line whose fields fit is told by its fields, as it was split already.
    fields = [F.coalesce(F.col(n), F.lit("")) for n in names]
    line = F.coalesce(F.col(_CORRUPT), F.concat_ws(",", *fields))
    return read.select(
        *[c.alias(n) for n, c in typed.items()], F.col(_FILE), line.alias("__row"), reason.alias("__reason")
    )


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header, for extracts with a varying column count."""
    return spark.read.options(**CSV_QUOTING).csv(path).columns


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rows of one partition value are written together, large ones over several files."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").options(**CSV_QUOTING)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def write_json_record(df: DataFrame, path: str) -> None:
    """A summary or metadata row as JSON."""
    df.write.mode("overwrite").json(path)


def scan_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)
