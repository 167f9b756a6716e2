"""Sources and sinks: delimited scan edge cases, CSV / JSON round trips."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tillsight.plans.registry import fixture_tables
from tillsight.plans.scratch import new_run_dir
from tillsight.sinks.files import read_csv_table, read_json_table, write_csv, write_json
from tillsight.sources.delimited import HeaderError, read_invoice_lines

from conftest import SF_SMALL


def _file(text: str) -> str:
    folder = tempfile.mkdtemp(prefix="tillsight-csv-")
    path = os.path.join(folder, "invoices.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_bom_header_short_long_and_quoted_rows(spark):
    text = (
        "\ufeffInvoiceNo; StockCode ;Description;Quantity;InvoiceDate;UnitPrice;CustomerID;Country\n"
        '1;A;"a;b";2;01/12/2010 08:26;1,5;7;UK\n'
        "2;B\n"
        "3;C;x;1;01/12/2010 08:26;1,5;7;UK;extra\n"
        '4;D;"";;01/12/2010 08:26;1,5;7;Ünïcode\n'
    )
    df = read_invoice_lines(spark, _file(text))
    assert df.columns == [
        "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
        "CustomerID", "Country",
    ]
    rows = {r["InvoiceNo"]: r for r in df.collect()}
    assert rows["1"]["Description"] == "a;b"
    assert rows["2"]["StockCode"] == "B" and rows["2"]["Country"] is None
    assert rows["3"]["Country"] == "UK"
    assert rows["4"]["Description"] is None and rows["4"]["Quantity"] is None
    assert rows["4"]["Country"] == "Ünïcode"


HEADER = "InvoiceNo;StockCode;Description;Quantity;InvoiceDate;UnitPrice;CustomerID;Country"


def test_columns_are_bound_by_name(spark):
    text = "StockCode;InvoiceNo; Country;Extra;CustomerID;UnitPrice;InvoiceDate;Quantity;Description \nA1;C500;UK;?;7;1,5;01/12/2010 08:26;2;x\n"
    row = read_invoice_lines(spark, _file(text)).first()
    assert row.asDict() == dict(zip(HEADER.split(";"), ["C500", "A1", "x", "2", "01/12/2010 08:26", "1,5", "7", "UK"]))


@pytest.mark.parametrize("header", ["a;b;c;d;e;f;g;h", HEADER + ";Country ", HEADER.replace("UnitPrice", "Price")])
def test_header_without_each_column_once_is_an_error(spark, header):
    with pytest.raises(HeaderError):
        read_invoice_lines(spark, _file(header + "\n" + ";".join("123456789"[: header.count(";") + 1]) + "\n"))


@pytest.mark.parametrize("read", [lambda df: df.collect(), lambda df: df.select("Country").collect()])
def test_files_with_different_headers_are_an_error(spark, tmp_path, read):
    other = ";".join(reversed(HEADER.split(";")))
    (tmp_path / "a.csv").write_text(HEADER + "\n1;A;x;2;01/12/2010 08:26;1,5;7;UK\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(other + "\nUK;7;1,5;01/12/2010 08:26;2;x;A;2\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        read(read_invoice_lines(spark, str(tmp_path)))


def test_large_tables_stay_distributed(spark, monkeypatch):
    from tillsight.sinks import files

    monkeypatch.setattr(files, "ONE_FILE_ROWS", 1000)
    countries = spark.range(0, 5000, 1, 8).selectExpr("concat('country ', id) AS Country", "id * 1.5D AS CountryRevenue")
    for path in (
        files.write_csv(countries, new_run_dir(spark, "test-large-csv"), small=True),
        files.write_json(countries, new_run_dir(spark, "test-large-json"), small=True),
    ):
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 8
    path = files.write_json_array(countries, new_run_dir(spark, "test-large-array"))
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 1


def test_json_array_of_a_million_rows(spark):
    """The part files one after the other are one JSON array in the frame's order; it reads back equal."""
    import json

    from tillsight.sinks.files import read_json_array, write_json_array

    rows = spark.range(0, 1_000_000, 1, 7).selectExpr("id AS Number", "if(id % 3 = 0, NULL, concat('a]}\n,[', id)) AS Name", "array(struct(id AS Inner)) AS Parts")
    path = write_json_array(rows, new_run_dir(spark, "test-million"))
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(parts) > 1
    text = "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in parts)
    document = json.loads(text)
    assert [r["Number"] for r in document] == list(range(1_000_000))
    assert document[4] == {"Number": 4, "Name": "a]}\n,[4", "Parts": [{"Inner": 4}]} and document[3]["Name"] is None
    back = read_json_array(spark, path, rows.schema)
    assert back.count() == 1_000_000 and back.exceptAll(rows).count() == 0


def test_json_array_parts_are_the_partitions(spark, monkeypatch):
    """Each partition is written where it lies, without a shuffle or a staged copy; empty ones may stand first and last."""
    import json

    from tillsight.sinks import files

    monkeypatch.setattr(files, "ONE_FILE_ROWS", 1000)
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda *_: pytest.fail("a range shuffle of the rows"))
    rows = spark.range(0, 8000, 1, 8).filter("id >= 1500 AND id < 6500").selectExpr("id AS Number", "if(id % 2 = 0, NULL, 'x') AS Name", "1 AS Same")
    path = files.write_json_array(rows, new_run_dir(spark, "test-array-parts"))
    parts = [open(os.path.join(path, f), encoding="utf-8").read() for f in sorted(os.listdir(path)) if f.startswith("part-")]
    parts = [p for p in parts if p]
    assert [p.count("\n") for p in parts] == [500, 1000, 1000, 1000, 1000, 500]
    assert [r["Number"] for r in json.loads("".join(parts))] == list(range(1500, 6500))
    back = files.read_json_array(spark, path, rows.schema)
    assert back.count() == 5000 and back.exceptAll(rows).count() == 0
    assert not files._is_kept(rows)


def test_json_array_leaves_a_kept_frame_kept(spark, monkeypatch):
    from tillsight.sinks import files

    monkeypatch.setattr(files, "ONE_FILE_ROWS", 10)
    rows = spark.range(0, 40, 1, 4).selectExpr("id % 3 AS Number").persist()
    try:
        path = files.write_json_array(rows, new_run_dir(spark, "test-kept-array"))
        assert files._is_kept(rows)
        assert files.read_json_array(spark, path, rows.schema).exceptAll(rows).count() == 0
    finally:
        rows.unpersist()


@pytest.mark.parametrize("limit", [10, 1000])
def test_json_array_of_repeated_rows(spark, monkeypatch, limit):
    import json

    from tillsight.sinks import files

    monkeypatch.setattr(files, "ONE_FILE_ROWS", limit)
    rows = spark.range(0, 60, 1, 5).selectExpr("if(id % 2 = 0, NULL, id) AS Key").union(spark.range(0, 60, 1, 3).selectExpr("CAST(NULL AS bigint)"))
    path = files.write_json_array(rows, new_run_dir(spark, "test-repeated"))
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    document = json.loads("".join(open(os.path.join(path, f), encoding="utf-8").read() for f in parts))
    assert [r["Key"] for r in document] == [r.Key for r in rows.collect()]


def test_json_array_leaves_no_scratch(spark, monkeypatch):
    from tillsight.plans.scratch import checkpoint_root
    from tillsight.sinks import files

    monkeypatch.setattr(files, "ONE_FILE_ROWS", 10)
    folder = f"{checkpoint_root(spark).removeprefix('file:')}/tillsight"
    files.write_json_array(spark.range(100), new_run_dir(spark, "test-scratch"))
    assert not [f for f in os.listdir(folder) if f.startswith("json-array-")]


def test_lines_of_other_lengths_are_recorded(spark):
    from tillsight.sources.delimited import malformed_lines, read_checked_lines

    good = '1;A;"x;""y";2;01/12/2010 08:26;1,5;7;UK'
    quoted = '1;A;"x;y";2;01/12/2010 08:26;1,5;7;UK;;"more;of it"'
    text = "\n".join([HEADER, good, "2;B;z", quoted, "3;C;;;;;;", '4;"a \\";b"']) + "\n"
    rows = read_checked_lines(spark, _file(text)).collect()
    assert len(rows) == 5 and sorted((r.FieldCount or 0) for r in rows) == [0, 0, 2, 3, 10]
    kept = {r.FieldCount: r.MalformedLine for r in rows if r.FieldCount}
    assert kept == {3: "2;B;z", 10: quoted, 2: '4;"a \\";b"'}
    short = next(r for r in rows if r.InvoiceNo == "2")
    assert short.Description == "z" and short.Quantity is None and short.Country is None
    plain = read_invoice_lines(spark, _file(text))
    assert read_checked_lines(spark, _file(text)).drop("MalformedLine", "FieldCount").exceptAll(plain).count() == 0
    assert malformed_lines(read_checked_lines(spark, _file(text))).select("InvoiceNo").count() == 3
    assert read_checked_lines(spark, _file(HEADER + "\n")).count() == 0


def test_named_files(spark):
    import json

    from tillsight.plans.export import EXPORTED_TABLES, export_all_tables, missing_tables
    from tillsight.plans.registry import FIXTURE_PARAMS
    from tillsight.sources.fixture import raw_invoice_lines

    root = new_run_dir(spark, "test-named-files")
    for _ in range(2):  # a second run replaces the first
        manifest = export_all_tables(spark, raw_invoice_lines(spark, SF_SMALL), root, FIXTURE_PARAMS, json_format="array", named_files=True).collect()
    folder = root.removeprefix("file:")
    assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == sorted(f"{n}.{k}" for n in EXPORTED_TABLES for k in ("csv", "json"))
    counts = {r.TableName: r.RowCount for r in manifest}
    for name in EXPORTED_TABLES:
        assert len(json.load(open(f"{folder}/{name}.json", encoding="utf-8"))) == counts[name]
    assert missing_tables(spark, root) == []


def test_small_writers_hold_no_table_in_one_value(spark):
    """No aggregate or window gathers a table of 100,000 countries: one streaming task."""
    from tillsight.sinks.files import read_json_array, write_json_array

    countries = spark.range(0, 100_000, 1, 8).selectExpr("concat('country ', id) AS Country", "id * 1.5D AS CountryRevenue")
    path = write_json_array(countries, new_run_dir(spark, "test-many-countries"))
    back = read_json_array(spark, path, countries.schema)
    assert back.count() == 100_000 and back.exceptAll(countries).count() == 0
    empty = write_json_array(countries.limit(0), new_run_dir(spark, "test-no-countries"))
    assert read_json_array(spark, empty, countries.schema).count() == 0


SCHEMA = StructType(
    [
        StructField("Name", StringType()),
        StructField("Amount", DoubleType()),
        StructField("Count", LongType()),
        StructField("Day", DateType()),
    ]
)
ROWS = [
    ("plain", 1.5, 3, dt.date(2011, 12, 9)),
    (None, None, None, None),
    ("semi;colon", 0.1, 1, dt.date(2000, 1, 1)),
    ('quote "x"', 1e-7, 2, dt.date(1999, 12, 31)),
    ("  padded  ", 123456789.01, 4, dt.date(2011, 1, 1)),
    ("Ünïcødé", -2.25, 5, dt.date(2011, 1, 2)),
]


def test_csv_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = write_csv(df, new_run_dir(spark, "test-csv"), small=True)
    back = read_csv_table(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)


def test_json_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = write_json(df, new_run_dir(spark, "test-json"), small=True)
    back = read_json_table(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)


def test_small_table_keeps_sort_order(spark):
    t = fixture_tables(spark, SF_SMALL)
    df = t.table("country_performance")
    path = write_csv(df, new_run_dir(spark, "test-order"), small=True)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    back = [r["Country"] for r in read_csv_table(spark, path, df.schema).collect()]
    assert back == [r["Country"] for r in df.collect()]


def test_export_all_tables_manifest(spark):
    import __spark_entry__ as entry

    manifest = {r["TableName"]: r["RowCount"] for r in entry.queries()["export_all_tables"](spark, SF_SMALL).collect()}
    assert len(manifest) == 15
    assert manifest["overall_kpis"] == 1 and manifest["top_customers"] == 10
    assert manifest["market_share_uk_vs_non_uk"] == 2


def test_exported_contents_equal_standalone_tables(spark):
    """Staged typed lines + invoice rollup + persisted shared aggregates give
    exactly the tables of the direct (unstaged) plan."""
    from tillsight.plans.catalog import EXPORTED_TABLES
    from tillsight.plans.export import export_all_tables, missing_tables
    from tillsight.plans.registry import FIXTURE_PARAMS
    from tillsight.sources.fixture import raw_invoice_lines

    root = new_run_dir(spark, "test-export")
    assert missing_tables(spark, root) == list(EXPORTED_TABLES)
    export_all_tables(spark, raw_invoice_lines(spark, SF_SMALL), root, FIXTURE_PARAMS).collect()
    assert missing_tables(spark, root) == []
    direct = fixture_tables(spark, SF_SMALL)
    for name in EXPORTED_TABLES:
        expected = direct.table(name)
        for back in (
            read_csv_table(spark, f"{root}/{name}/csv", expected.schema),
            read_json_table(spark, f"{root}/{name}/json", expected.schema),
        ):
            assert back.exceptAll(expected).count() == 0, name
            assert expected.exceptAll(back).count() == 0, name
    # sorted tables keep their order in the single exported file
    got = [r["Country"] for r in read_csv_table(spark, f"{root}/country_performance/csv", direct.table("country_performance").schema).collect()]
    assert got == [r["Country"] for r in direct.table("country_performance").collect()]


def test_missing_tables_reports_partial_export(spark):
    from tillsight.plans.catalog import EXPORTED_TABLES
    from tillsight.plans.export import missing_tables

    root = new_run_dir(spark, "test-partial-export")
    t = fixture_tables(spark, SF_SMALL)
    for name in ("overall_kpis", "hourly_sales"):
        write_csv(t.table(name), f"{root}/{name}/csv", small=True)
    missing = missing_tables(spark, root)
    assert "overall_kpis" not in missing and "hourly_sales" not in missing
    assert len(missing) == len(EXPORTED_TABLES) - 2


def test_json_array_round_trip_keeps_order(spark):
    import json

    from tillsight.sinks.files import read_json_array, write_json_array

    t = fixture_tables(spark, SF_SMALL)
    df = t.table("country_performance")
    path = write_json_array(df, new_run_dir(spark, "test-json-array"))
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 1
    with open(os.path.join(path, files[0]), encoding="utf-8") as fh:
        doc = json.load(fh)
    assert isinstance(doc, list) and [r.get("Country") for r in doc] == [r["Country"] for r in df.collect()]
    back = read_json_array(spark, path, df.schema)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_export_with_json_arrays(spark):
    from tillsight.plans.export import export_all_tables
    from tillsight.plans.registry import FIXTURE_PARAMS
    from tillsight.sinks.files import read_json_array
    from tillsight.sources.fixture import raw_invoice_lines

    root = new_run_dir(spark, "test-export-array")
    export_all_tables(spark, raw_invoice_lines(spark, SF_SMALL), root, FIXTURE_PARAMS, json_format="array").collect()
    direct = fixture_tables(spark, SF_SMALL)
    for name in ("overall_kpis", "customer_segment_summary", "top_customers", "potential_growth_markets"):
        expected = direct.table(name)
        back = read_json_array(spark, f"{root}/{name}/json", expected.schema)
        assert back.exceptAll(expected).count() == 0 and expected.exceptAll(back).count() == 0, name
