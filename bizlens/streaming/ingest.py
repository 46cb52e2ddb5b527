"""Incremental landing of monthly report files with Structured Streaming.

New raw extract files (Parquet/CSV/JSON with the declared headers and ``data_competencia``) dropped into an inbox
folder are picked up once each (the file source keeps the set of processed files in the checkpoint).

The unit of replacement is the delivery: a folder of the inbox (files directly in the inbox are the delivery ``""``, the
oldest). Every micro-batch adds its rows under its delivery, so how files fall into batches does not matter, and a
batch run again overwrites its own rows. A report lands either by stream or by ``land``, not by both. Of each month, readers see all files of the delivery that sorts last.
``Trigger.AvailableNow`` drains what is there and stops, which fits the monthly schedule; the same query runs
continuously with a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bizlens.sources import landing as LD
from bizlens.sources.catalog import ReportSpec


def read_inbox(spark: SparkSession, inbox: str, report: ReportSpec, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame over the inbox with the report's fixed all-string schema (no inference)."""
    reader = spark.readStream.schema(report.schema).format(fmt).option("recursiveFileLookup", "true")
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    folder = inbox.rstrip("/").rsplit("/", 1)[-1]
    inside = F.substring_index("_metadata.file_path", f"/{folder}/", -1)
    # The prefix keeps the partition value a text, whatever the folder's name.
    return reader.load(inbox).withColumn(LD.DELIVERY, F.concat(F.lit("e-"), F.regexp_extract(inside, "^(.*)/[^/]*$", 1)))


def start_landing(spark: SparkSession, inbox: str, landing_root: str, report: ReportSpec, fmt: str = "parquet",
                  checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the inbox -> landing query; the checkpoint lives beside the landing table unless given, so a restart
    goes on where the last run ended."""
    checkpoint = checkpoint or f"{landing_root}/_checkpoints/{LD.report_key(report)}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        LD.land(batch, landing_root, report, batch_id)

    writer = read_inbox(spark, inbox, report, fmt).writeStream.foreachBatch(merge) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
