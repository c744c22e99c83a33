"""Monthly zip archives → CSV lines, with year and month from the file name.

Each archive must hold exactly one ``.csv`` member. Spark lists the archives
(``binaryFile`` with only the ``path`` column selected, so no archive is
loaded into a row); one partition of the ``monthly_zip`` source opens it, checks the
members and streams the CSV member's lines out in Arrow batches of bounded
size, each with its 0-based line number. An archive cannot be split, so the
parallelism of this step is the number of archives; everything after it is
repartitioned and runs wide.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# ``…_{year}_{month}.zip``: the last two ``_`` tokens of the name before the
# extension are year and month.
ZIP_NAME_PATTERN = r"(?:^|.*[/_])([0-9]+)_([0-9]+)\.zip$"
# ---------------------------------------------------------------------------

LINE_BATCH = 20000
# year/month of the archive name (the raw rows have their own Year/Month
# columns, and Spark column names are case-insensitive)
LINES_SCHEMA = "path string, file_year int, file_month int, line_no long, value string"


# Hadoop's names of schemes that Arrow knows by another
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def file_system(path: str):
    """(Arrow file system, path on it) of a path as Hadoop writes it."""
    from pyarrow import fs
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if colon else path
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def _extractor(line_batch: int = LINE_BATCH):
    """The task function, made inside a function so that workers get it by
    value: they need not have this package installed."""
    # Hadoop's names of schemes that Arrow knows by another
    schemes = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}

    def opened(path):
        scheme, colon, rest = path.partition(":")
        if not colon or scheme == "file":
            return open("/" + rest.lstrip("/") if colon else path, "rb")
        from pyarrow import fs
        filesystem, p = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
        return filesystem.open_input_file(p)

    def batch(path, year, month, start, lines):
        n = len(lines)
        return pd.DataFrame({"path": [path] * n, "file_year": [int(year)] * n,
                             "file_month": [int(month)] * n,
                             "line_no": range(start, start + n), "value": lines})

    def extract(batches):
        for pdf in batches:
            for path, year, month in zip(pdf["path"], pdf["file_year"], pdf["file_month"]):
                with opened(path) as fh, zipfile.ZipFile(fh) as zf:
                    members = [m for m in zf.namelist() if m.lower().endswith(".csv")]
                    if len(members) != 1:
                        raise ValueError(f"{path}: expected exactly one .csv member, found {len(members)}")
                    with zf.open(members[0]) as raw:
                        # bytes that are not UTF-8 fail the load
                        text = io.TextIOWrapper(raw, encoding="utf-8", newline="")
                        buf, start = [], 0
                        for line in text:
                            buf.append(line.rstrip("\r\n"))
                            if len(buf) >= line_batch:
                                yield batch(path, year, month, start, buf)
                                start += len(buf)
                                buf = []
                        if buf:
                            yield batch(path, year, month, start, buf)

    return extract


def list_archives(spark: SparkSession, zip_glob: str) -> DataFrame:
    """(path, file_year, file_month, name_ok) of every archive matching ``zip_glob``."""
    files = spark.read.format("binaryFile").load(zip_glob).select("path")
    y = F.regexp_extract("path", ZIP_NAME_PATTERN, 1)
    m = F.regexp_extract("path", ZIP_NAME_PATTERN, 2)
    ok = (y != "") & (m != "")
    return files.select("path", F.when(ok, y.cast("int")).alias("file_year"),
                        F.when(ok, m.cast("int")).alias("file_month"), ok.alias("name_ok"))


def read_zip_lines(spark: SparkSession, zip_glob: str, strict_names: bool = True) -> DataFrame:
    """CSV lines of all monthly archives: ``path, file_year, file_month, line_no, value``.

    A name without ``_{year}_{month}.zip`` (e.g. a duplicate download
    ``2020_05 (1).zip``) raises when ``strict_names``, else is skipped.
    """
    arch = list_archives(spark, zip_glob)
    if strict_names:
        arch = arch.withColumn("_chk", F.when(~F.col("name_ok"), F.raise_error(
            F.concat(F.lit("archive name has no _year_month: "), F.col("path")))))
        arch = arch.filter(F.col("_chk").isNull())
    from .zip_format import read_archives
    # names only, one for each archive
    found = arch.filter("name_ok").select("path", "file_year", "file_month").orderBy("path").collect()
    return read_archives(spark, [tuple(r) for r in found])
