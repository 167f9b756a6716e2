"""Incremental ingest of invoice files (streaming form of S1 + T1).

The original job has no streaming operator: it re-reads one whole CSV per
run.  When invoice files keep arriving in a landing folder, the same scan and
typing run as a Structured Streaming file source, and each micro-batch is
appended to a Parquet table of typed lines.  Every batch table (KPIs, trends,
RFM, markets) then reads that table through ``cleaned_sales`` unchanged, and
no file is ever parsed twice.  Progress (which files were consumed) lives in
one checkpoint per table, by default inside the table's own folder, so every
run and every restart goes on where the last one ended.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillsight.operators.prepare import typed_sales
from tillsight.sources.delimited import READER_OPTIONS, bind_columns, raw_schema

# Hidden from readers of the table by its underscore.
CHECKPOINT_FOLDER = "_ingest_checkpoint"


def invoice_line_stream(spark: SparkSession, landing_dir: str, **options: str) -> DataFrame:
    """Streaming S1: every new ';' invoice CSV in ``landing_dir``, columns bound by name.

    The header of the first file present gives the names (an empty folder: the
    declared ones in order); a file with another header stops the query.
    """
    settings = {**READER_OPTIONS, **options}
    try:
        names = tuple(spark.read.options(**settings).csv(landing_dir).schema.names)
    except AnalysisException as empty:
        if empty.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        names = ()
    schema = raw_schema(names) if names else raw_schema()
    return bind_columns(spark.readStream.schema(schema).options(**settings).csv(landing_dir))


def start_typed_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_dir: str,
    checkpoint_dir: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append typed invoice lines from newly arrived files to a Parquet table.

    ``available_now`` processes everything present and stops (a scheduled
    incremental job); otherwise the query keeps polling the landing folder.
    Without ``checkpoint_dir`` the table's own hidden folder is used, the same
    at each run.
    """
    options = {}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    typed = typed_sales(invoice_line_stream(spark, landing_dir, **options))
    checkpoint = checkpoint_dir or f"{table_dir.rstrip('/')}/{CHECKPOINT_FOLDER}"
    writer = typed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(table_dir)
