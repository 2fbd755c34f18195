"""Incremental load of arriving sales files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.build import load_increment
from ..sources.feeds import CORRUPT, CSV_OPTIONS


def sales_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Sales files of a folder as a stream of feed rows, with broken lines marked."""
    schema = T.StructType([*schemas.SALES.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def load_available(
    stream: DataFrame, masters: dict[str, DataFrame], root: str, checkpoint: str, *, merge: bool = False,
    lateness: int | None = None, name: str = "stream", **labels: str,
) -> StreamingQuery:
    """Bring all files that have arrived since the last run into the tables below ``root``, and stop.

    Each batch is an incremental load of its own, named by its number: the checkpoint remembers which files are loaded,
    and a batch that is tried again after a failure replaces its own lines, so none is dropped or repeated. Files
    are taken whatever dates they hold; broken lines go to quarantine and do not stop the stream. With ``merge`` a file
    that arrives again under another name adds nothing. ``lateness`` is the watermark: lines that many days older than
    the last stored day go to quarantine as late. ``name`` tells the loads of several streams into one root apart.
    """

    def load(batch: DataFrame, number: int) -> None:
        feeds = {**masters, "Sales": batch}
        load_increment(
            batch.sparkSession, feeds, root, f"{name}-{number}", whole_days=False, merge=merge, lateness=lateness, **labels
        )

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
