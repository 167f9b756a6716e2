"""Distributed CSV / JSON sinks and typed read-back.

The original collected every table to the driver and wrote files with the
Python csv/json modules.  Here executors write through ``DataFrameWriter``.
Only tables that are small when counted are coalesced to one file, which also
keeps their sort order; all others keep their partitioning.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# ISO-8601 value serialisation.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

CSV_WRITE_OPTIONS = {
    "header": "true",
    "dateFormat": DATE_FORMAT,
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "encoding": "UTF-8",
    # Spark's writer strips padding by default; keep values byte for byte so
    # blank-vs-NULL survives a round trip.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ_OPTIONS = {
    "header": "true",
    "dateFormat": DATE_FORMAT,
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "encoding": "UTF-8",
    "mode": "FAILFAST",
}
JSON_OPTIONS = {
    "dateFormat": DATE_FORMAT,
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "encoding": "UTF-8",
}


# A result table of up to so many rows is written by one task as one file.
ONE_FILE_ROWS = 100_000


def _shaped(df: DataFrame, small: bool, rows: int | None) -> DataFrame:
    """``small`` asks for one file; a table over ``ONE_FILE_ROWS`` keeps its partitions.
    Without ``rows``, its number of rows, the table is counted."""
    if not small:
        return df
    return df.coalesce(1) if (df.count() if rows is None else rows) <= ONE_FILE_ROWS else df


def write_csv(df: DataFrame, path: str, small: bool = False, rows: int | None = None, **options: str) -> str:
    """Header CSV directory at ``path`` (overwritten)."""
    _shaped(df, small, rows).write.mode("overwrite").options(**{**CSV_WRITE_OPTIONS, **options}).csv(path)
    return path


def write_json(df: DataFrame, path: str, small: bool = False, rows: int | None = None, **options: str) -> str:
    """JSON Lines directory at ``path`` (one object per row, UTF-8)."""
    _shaped(df, small, rows).write.mode("overwrite").options(**{**JSON_OPTIONS, **options}).json(path)
    return path


def write_json_array(df: DataFrame, path: str, rows: int | None = None, **options: str) -> str:
    """S6, array form: the part files of ``path``, one after the other by name, are one JSON array
    of row objects in the frame's order; up to ``ONE_FILE_ROWS`` rows are one file.

    Every line is one object, with the bracket or comma that its place in the whole array asks
    for.  The frame is computed once and kept until it is written (unless the caller keeps it already).  Its
    rows are numbered by partition and place in it: a first job over what is kept finds the first and the last
    number, which get the brackets, and a second writes each partition as a part of its own.
    The text is neither staged nor shuffled, and of a larger table nothing is gathered in one task or on the driver.
    """
    settings = {**JSON_OPTIONS, "ignoreNullFields": "false", **options}
    numbered = lambda table, *columns: table.select(F.monotonically_increasing_id().alias("_at"), *columns)
    own = not _is_kept(df)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if own else df
    try:
        count, first, last = numbered(kept).agg(F.count("_at"), F.min("_at"), F.max("_at")).first()
        objects = numbered(kept, F.to_json(F.struct(*df.columns), settings).alias("_row"))
        if not count:
            text = df.sparkSession.sql("SELECT '[]' AS value")
        elif (count if rows is None else rows) <= ONE_FILE_ROWS:
            text = _in_brackets(objects.coalesce(1).sortWithinPartitions("_at"), first, last)
        else:
            text = _in_brackets(objects, first, last)
        text.write.mode("overwrite").text(path)
    finally:
        if own:
            kept.unpersist()
    return path


def _is_kept(df: DataFrame) -> bool:
    """Whether ``df`` is persisted already."""
    level = df.storageLevel
    return level.useMemory or level.useDisk


def _in_brackets(objects: DataFrame, first: int, last: int) -> DataFrame:
    before = F.when(F.col("_at") == first, "[").otherwise(",")
    after = F.when(F.col("_at") == last, "]").otherwise("")
    return objects.select(F.concat(before, "_row", after).alias("value"))


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what ``write_json_array`` wrote, line by line in parallel: what stands around an
    object is its bracket or comma before, and a bracket after the last one."""
    line = F.col("value")
    bare = F.when(F.endswith(line, F.lit("}]")), F.expr("substring(value, 2, length(value) - 2)")).otherwise(F.expr("substring(value, 2)"))
    objects = spark.read.text(path).filter(line != "[]").select(bare.alias("_row"))
    return objects.select(F.from_json("_row", schema, {**JSON_OPTIONS, "mode": "FAILFAST"}).alias("_row")).select("_row.*")


def as_named_file(spark: SparkSession, folder: str, target: str) -> bool:
    """Move the only part file of ``folder`` to ``target`` (replaced) and drop the folder;
    False, with the folder left alone, if it has several."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at, to = fs_path(folder), fs_path(target)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        return False
    fs.delete(to, True)
    fs.rename(parts[0], to)
    fs.delete(at, True)
    return True


def read_csv_table(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """Re-read an exported CSV table with its declared schema."""
    return spark.read.schema(schema).options(**{**CSV_READ_OPTIONS, **options}).csv(path)


def read_json_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S4 for JSON Lines exports."""
    return spark.read.schema(schema).options(**JSON_OPTIONS, mode="FAILFAST").json(path)
