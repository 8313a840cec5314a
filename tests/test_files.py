"""Checked CSV scans and scans grouped by footer schema, on odd files."""

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from vintagemart.sources import files

SCHEMA = StructType(
    [StructField("id", IntegerType()), StructField("name", StringType()), StructField("born", DateType())]
)


def scan(spark, folder, texts):
    paths = []
    for i, text in enumerate(texts):
        path = folder / f"{i}.csv"
        path.write_text(text, encoding="utf-8")
        paths.append(str(path))
    rows, rejects = files.scan_csv_checked(spark, paths, SCHEMA)
    assert rows.schema.names == SCHEMA.names
    told = [(r["file"].rsplit("/", 1)[-1], r["row"], r["reason"]) for r in rejects.collect()]
    return sorted(map(tuple, rows.collect()), key=str), sorted(told, key=str), rows


def test_columns_are_matched_by_name(spark, tmp_path):
    rows, told, read = scan(
        spark,
        tmp_path,
        [
            "name,id,born\n\"a, \"\"b\"\"\",1,2024-01-31\n",
            "id,name,born,more\n2,b,2024-02-01,x\n",
            "﻿born,name,id\n2024-03-01,é,3\n",
            "name,id,born\nd,4,\n",
        ],
    )
    assert [(r[0], r[1], str(r[2])) for r in rows] == [
        (1, 'a, "b"', "2024-01-31"), (2, "b", "2024-02-01"), (3, "é", "2024-03-01"), (4, "d", "None"),
    ]
    assert told == []
    # One scan per header, not per file.
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3


def test_bad_lines_and_files_are_told(spark, tmp_path):
    rows, told, _ = scan(
        spark,
        tmp_path,
        [
            "id,name,born\n1,a,2024-01-01\n2,b\n3,c,2024-01-01,x\nx,d,2024-01-01\n5,e,soon\n,,\n",
            "id,name\n6,f\n",
            "id,name,born,id\n7,g,2024-01-01,8\n",
            "",
            "id,name,born\n",
        ],
    )
    assert [r[0] for r in rows] == [1, None]
    assert told == [
        ("0.csv", "2,b", "number of fields"),
        ("0.csv", "3,c,2024-01-01,x", "number of fields"),
        ("0.csv", "5,e,soon", "born: soon"),
        ("0.csv", "x,d,2024-01-01", "id: x"),
    ] + [
        (f"{i}.csv", None, reason)
        for i, reason in ((1, "no column ['born']"), (2, "column twice ['id']"), (3, "no column ['born', 'id', 'name']"))
    ]


def test_no_files(spark):
    rows, rejects = files.scan_csv_checked(spark, [], SCHEMA)
    assert rows.count() == 0 and rejects.count() == 0
    with pytest.raises(Exception):
        files.csv_headers(spark, ["/no/such/file.csv"])


def test_plain_scan_refuses_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,id,born\n1,2,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, str(tmp_path), SCHEMA).collect()
