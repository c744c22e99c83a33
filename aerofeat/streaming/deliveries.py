"""Incremental monthly loads: a file stream of archives as the record of what
is loaded.

The stream's checkpoint lists the archives that were taken; each run takes the
new ones alone (``availableNow``), as one or more micro-batches, and refreshes
raw table, model and metrics with them. Only names travel through the stream: an
archive is opened by the load itself. A micro-batch that failed half way is run
again with the same archives, and replaces what it has written of their months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

ARCHIVE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def archive_stream(spark: SparkSession, zip_dir: str, max_files: int | None = None) -> DataFrame:
    """(``path``) of the archives below ``zip_dir`` as they arrive; the
    content is not read."""
    reader = spark.readStream.format("binaryFile").schema(ARCHIVE_SCHEMA).option("pathGlobFilter", "*.zip")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(zip_dir).select("path")


def refresh_deliveries(spark: SparkSession, zip_dir: str, raw_dir: str, metrics_dir: str, split_date: str,
                       checkpoint: str, max_files: int | None = None, **refresh) -> None:
    """``monthly_refresh`` for the archives of ``zip_dir`` that ``checkpoint``
    does not know yet; nothing is done where there is none. ``max_files`` bounds
    the archives of one micro-batch; further arguments go to ``monthly_refresh``."""
    from ..plans.jobs import monthly_refresh
    configure(spark)

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())     # names of this delivery's archives
        if paths:
            monthly_refresh(batch.sparkSession, paths, raw_dir, metrics_dir, split_date, **refresh)

    query = archive_stream(spark, zip_dir, max_files).writeStream.foreachBatch(load) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
