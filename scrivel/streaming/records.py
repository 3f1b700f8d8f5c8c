"""Clean landed JSON documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scrivel.operators.records import clean_records, with_markdown
from scrivel.schemas import RAW_RECORD
from scrivel.sinks.records import write_record_files
from scrivel.sources.files import file_stem


def landed_records(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """Streaming counterpart of the JSON folder scan, with the file's ``stem``."""
    files = (
        spark.readStream.schema(RAW_RECORD)
        .option("multiLine", "true")
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )
    return files.select(file_stem().alias("stem"), "*")


def clean_as_landed(
    spark: SparkSession, folder: str, output: str, checkpoint: str, salt: str
) -> StreamingQuery:
    """Start a run over everything not cleaned yet; the Parquet sink takes each file once."""
    return (
        clean_records(landed_records(spark, folder), salt)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def export_as_landed(
    spark: SparkSession, folder: str, output: str, checkpoint: str, salt: str, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Start a run that writes a ``{stem}.md`` for every file not exported yet.

    A batch that is run again, after a failure between its files and its checkpoint, replaces its own files, so each file is
    there once whatever happens.
    """
    rendered = with_markdown(clean_records(landed_records(spark, folder, files_per_batch), salt))
    return (
        rendered.writeStream.foreachBatch(lambda batch, _: write_record_files(batch, output))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
