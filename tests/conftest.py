from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"

RAW = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
       "CustomerID", "Country")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("tillsight-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their session: set a checkpoint folder only where none is set.
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillsight-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def raw_frame(spark):
    """Build a raw invoice frame (eight nullable strings) from tuples."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField(c, StringType(), True) for c in RAW])

    def make(rows):
        return spark.createDataFrame(rows, schema)

    return make
