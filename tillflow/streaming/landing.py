"""Repeated uploads as a stream: each new file in a folder is loaded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.functions.text import missing_to_null
from tillflow.plans.load import load_sales
from tillflow.schemas import POSITION, RAGGED
from tillflow.sources.sales_files import (DIALECT, decoded_columns, distinct_headers,
                                          header_options, keeping_ragged, quoted, raw_header)
from tillflow.sources.tables import SavedTables

_FILE = "_file"


def sales_file_stream(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Raw rows of the files that arrive in ``folder``, with their file's place."""
    schema, checks = header_options(raw_header(spark, folder, "ISO-8859-1", **options))
    schema, keep = keeping_ragged(schema, RAGGED)
    checks |= keep
    stream = decoded_columns(spark.readStream.options(**{**DIALECT, **options}, **checks).schema(
        schema).csv(folder, encoding="ISO-8859-1").withColumn(_FILE, F.col("_metadata")))
    place = F.struct(
        F.col(f"{_FILE}.file_modification_time"), F.col(f"{_FILE}.file_name"),
        F.col(f"{_FILE}.file_block_start"),
    )
    columns = [c for c in stream.columns if c != _FILE]
    return stream.select(*[missing_to_null(quoted(old)).alias(new)
                           for old, new in zip(columns, distinct_headers(columns))],
                         place.alias(_FILE))


def with_position(batch: DataFrame) -> DataFrame:
    """The row's position: its file's place, then the row order inside it."""
    position = F.struct(f"{_FILE}.*", F.monotonically_increasing_id().alias("row_id"))
    return batch.withColumn(POSITION, position).drop(_FILE)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint. One made anew has another id, so its batch
    numbers, which begin again, do not overwrite what earlier batches kept."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def land_sales(tables: SavedTables, folder: str, checkpoint: str,
               options: dict | None = None, max_files: int | None = None,
               **load_options) -> StreamingQuery:
    """Load all files that arrived since the last run, then stop.

    The stream's checkpoint remembers the files; an upsert that is repeated after a
    failure gives the same fact. Late days are welcome, so every row is loaded.
    """
    load_options.setdefault("process_type", "full")
    limits = {"maxFilesPerTrigger": max_files} if max_files else {}
    stream = sales_file_stream(tables.spark, folder, **(options or {}), **limits)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        label = f"stream-{stream_id(tables.spark, checkpoint)}-{batch_id}"
        load_sales(tables, with_position(batch), load_id=label, **load_options)

    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
