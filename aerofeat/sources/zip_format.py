"""``monthly_zip``: monthly zip archives as a Spark data source.

Reading: one partition for each archive, its CSV lines as
``path, file_year, file_month, line_no, value``. The archives are listed by
Spark (``zips.read_zip_lines``) and come as an option.

Writing: one archive ``flights_{year}_{month}.zip`` for each month, with one CSV member.
Tasks write below a folder of this write's own; only when all have ended does the
commit move the archives to their names (replacing those of the same months),
and an abort deletes the folder. Readers see whole archives or none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .zips import LINES_SCHEMA, _extractor, file_system

FORMAT = "monthly_zip"
MONTH = ["file_year", "file_month"]


@dataclass
class Archive(InputPartition):
    path: str
    year: int
    month: int


@dataclass
class Written(WriterCommitMessage):
    """Archives that a task has closed: (folder and name below the write's, final name)."""
    archives: list = field(default_factory=list)


class ZipReader(DataSourceReader):
    def __init__(self, archives: list):
        self.archives = archives

    def partitions(self):
        return [Archive(*a) for a in self.archives]

    def read(self, partition):
        import pandas as pd
        import pyarrow as pa
        if partition is None:               # no archives
            return
        schema = pa.schema([("path", pa.string()), ("file_year", pa.int32()), ("file_month", pa.int32()),
                            ("line_no", pa.int64()), ("value", pa.string())])
        one = pd.DataFrame({"path": [partition.path], "file_year": [partition.year], "file_month": [partition.month]})
        for lines in _extractor()([one]):
            yield pa.RecordBatch.from_pandas(lines, schema, preserve_index=False)


class ZipWriter(DataSourceArrowWriter):
    """Rows (``file_year``, ``file_month``, ``value``) → archives. A month must
    reach one task, in line order (``write_archives`` sees to it)."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.work = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        import io
        import zipfile
        fs, work = file_system(self.work)
        folder = f"{work}/{uuid.uuid4().hex}"       # an attempt's own: a task may run more than once
        fs.create_dir(folder, recursive=True)
        done, months, month, out = [], set(), None, None

        def closed():
            if out:
                for part in out[::-1]:
                    part.close()
        try:
            for batch in iterator:
                rows = batch.to_pydict()
                for y, m, value in zip(rows["file_year"], rows["file_month"], rows["value"]):
                    if (y, m) != month:
                        closed()
                        if (y, m) in months or y is None or m is None:
                            raise ValueError(f"rows of month {y}-{m} do not follow each other")
                        month, name = (y, m), f"flights_{y}_{m:02d}.zip"
                        months.add(month)
                        sink = fs.open_output_stream(f"{folder}/{name}")
                        archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                        member = archive.open(f"{y}-{m:02d}.csv", "w", force_zip64=True)
                        out = [sink, archive, member, io.TextIOWrapper(member, "utf-8", newline="")]
                        done.append((f"{folder}/{name}", name))
                    out[-1].write((value or "") + "\n")
        finally:
            closed()
        return Written(done)

    def commit(self, messages):
        fs, path = file_system(self.path)
        archives = [a for message in messages if message for a in message.archives]
        names = [name for _, name in archives]
        if len(set(names)) < len(names):
            raise ValueError("a month was written by more than one task")
        for written, name in archives:
            fs.move(written, f"{path}/{name}")
        self.abort(messages)

    def abort(self, messages):
        fs, work = file_system(self.work)
        from pyarrow.fs import FileType
        if fs.get_file_info(work).type != FileType.NotFound:
            fs.delete_dir(work)


class MonthlyZips(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return LINES_SCHEMA

    def reader(self, schema):
        return ZipReader(json.loads(self.options["archives"]))

    def writer(self, schema, overwrite):
        return ZipWriter(self.options["path"])


def read_archives(spark: SparkSession, archives: list[tuple[str, int, int]]) -> DataFrame:
    """Lines of the given archives (path, year, month)."""
    spark.dataSource.register(MonthlyZips)
    return spark.read.format(FORMAT).option("archives", json.dumps(archives)).load()


def write_archives(rows: DataFrame, path: str, order: list[str]) -> None:
    """``rows`` (``file_year``, ``file_month``, ``value``, and the columns that
    give the order of lines) as monthly archives below ``path``. A month is one
    archive and so one task, sorted by Spark (which spills); its lines stream out."""
    rows.sparkSession.dataSource.register(MonthlyZips)
    dealt = rows.repartition(*MONTH).sortWithinPartitions(*MONTH, *order)
    dealt.select(*[F.col(c).cast("int").alias(c) for c in MONTH], F.col("value").cast("string").alias("value")) \
        .write.format(FORMAT).mode("append").save(path)
