"""CSV sources: positional raw reader, line decoder, by-name reader, and the
ordered first-N read.

Files are read with ``spark.read.csv`` and an explicit schema: the scan is
split across tasks, only the columns a query uses are tokenised (Catalyst
prunes the CSV ``ReadSchema``), and simple filters are pushed into the scan.
"""

from __future__ import annotations

import functools
import re
import urllib.parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS, RAW_SCHEMA, TRAIN_SOURCE_COLUMNS

# RFC-4180 style quoting: a quote inside a quoted field is doubled.
CSV_OPTIONS = {"escape": '"', "quote": '"', "sep": ",", "mode": "PERMISSIVE"}


def read_raw_csv(spark: SparkSession, path) -> DataFrame:
    """Positional read of raw flight CSV files (a path, a glob or a list).

    Fields bind to :data:`RAW_COLUMNS` by position; surplus trailing fields are
    dropped, missing ones are null, and empty fields (quoted or not) are null.
    Header rows are *not* skipped here: they can occur anywhere (concatenated
    monthly files), so the parser drops them by value. Only the columns a
    query uses are tokenised (CSV column pruning), which also means a short
    line is not told apart from empty fields; :func:`read_raw_lines` does
    that, for the strict parser.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("header", False)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.schema(RAW_SCHEMA).csv(paths)


def read_raw_lines(spark: SparkSession, path) -> DataFrame:
    """Raw rows with each line's field count (``_n_fields``): a text scan
    decoded with ``from_csv``. Tokenises all fields; used by strict parsing."""
    paths = [path] if isinstance(path, str) else list(path)
    return decode_lines(spark.read.text(paths), with_field_count=True)


def raw_ddl(columns=RAW_COLUMNS) -> str:
    return ", ".join(f"`{c}` STRING" for c in columns)


def decode_lines(lines: DataFrame, line_col: str = "value", keep: tuple = (),
                 with_field_count: bool = False) -> DataFrame:
    """Decode a column of CSV lines into the 109 positional string columns.

    For lines that are already a column (a text scan, a Kafka value, a zip
    member). ``from_csv`` with options tokenises every field, so prefer
    :func:`read_raw_csv` for files. Blank lines are skipped, as the file reader
    does; with the field count (strict parsing) they stay, one empty field each,
    and fail as any short line does.
    """
    from ..functions.flight import csv_field_count

    line = F.col(line_col)
    rec = F.from_csv(line, raw_ddl(), {k: v for k, v in CSV_OPTIONS.items() if k != "mode"})
    cols = [F.col(k) for k in keep] + [rec.alias("_r")]
    if with_field_count:
        cols.append(csv_field_count(line).alias("_n_fields"))
    if not with_field_count:
        lines = lines.filter(F.length(F.trim(line)) > 0)
    out = lines.select(*cols)
    return out.select(*keep, "_r.*", *(["_n_fields"] if with_field_count else []))


def encode_lines(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """Render rows positionally as CSV lines (109 fields; columns of ``df``
    named like a raw column fill that position, the rest stay empty).
    Fields holding a separator or quote are quoted and quotes doubled."""
    present = set(df.columns)
    fields = [F.col(c).cast("string").alias(c) if c in present
              else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    line = F.to_csv(F.struct(*fields), {"quote": '"', "escape": '"', "sep": ","})
    return df.select(*keep, line.alias("value"))


HEADERS = 100       # files whose header one job reads


def header_groups(spark: SparkSession, path) -> dict[tuple[str, ...], list[str]]:
    """Files by their header: {column names: paths}. One job asks ``HEADERS``
    files for their first line that is not empty, each by a scan that ends there."""
    paths = [path] if isinstance(path, str) else list(path)
    names = F.split(F.regexp_replace("value", "^\ufeff", ""), ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", -1)
    files = sorted(spark.read.text(paths).inputFiles())
    # one task a file: of a file in several splits, a limit could take the first line of any split. A
    # multi-line scan is not split; without quotes and with a separator that no header has, a row is a line
    lines = spark.read.options(multiLine=True, header=False, quote="", sep="\u0001").schema("value string")
    groups: dict[tuple[str, ...], list[str]] = {}
    for i in range(0, len(files), HEADERS):
        firsts = [lines.csv(f).limit(1).select(F.lit(f).alias("file"), names.alias("names")) for f in files[i:i + HEADERS]]
        # an empty file has no first line, and no rows either
        for r in sorted(functools.reduce(DataFrame.union, firsts).collect()):
            groups.setdefault(tuple(n.strip().strip('"').replace('""', '"') for n in r["names"]), []).append(r["file"])
    return groups


def read_named_csv(spark: SparkSession, path, columns=TRAIN_SOURCE_COLUMNS,
                   with_order: bool = False) -> DataFrame:
    """By-name read of CSV files with a header row, keeping ``columns``.

    The header of each file decides which position each name has: files may
    order their columns differently or have more (an index column). Files of
    one header are one scan, and the scans are united by name. Every kept column
    is read as a string and converted by the caller with ``try_cast``:
    explicit and one pass, where type inference would need an extra scan and
    can give different types for different months.
    """
    parts = []
    for names, files in header_groups(spark, path).items():
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"columns not in the CSV header of {files[0]}: {missing}")
        # names of columns that are not kept may repeat or be empty
        fields = [f"`{n}` string" if n in columns else f"`_{i}` string" for i, n in enumerate(names)]
        df = spark.read.options(**CSV_OPTIONS).option("header", True).option("enforceSchema", True) \
            .schema(", ".join(fields)).csv(files)
        parts.append(df.select(*columns, *order_columns()) if with_order else df.select(*columns))
    if not parts:
        raise ValueError(f"no CSV file at {path}")
    return functools.reduce(DataFrame.unionByName, parts)


ORDER_COLUMNS = ["_file", "_block", "_pos"]


def order_columns():
    """File order of a file scan: file path, split start, position in split."""
    return [F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos")]


def head_files(files: list[str], n: int, count) -> list[str]:
    """The fewest of the ordered ``files`` that hold the first ``n`` rows:
    ``count(files)`` gives {file: rows}, and is asked for as many files again as
    were counted so far until the prefix sum reaches ``n``. Files behind are not opened."""
    total, taken = 0, 0
    while taken < len(files) and total < n:
        asked = files[taken:2 * taken + 1]
        rows = count(asked)
        for f in asked:
            total, taken = total + rows.get(f, 0), taken + 1
            if total >= n:
                break
    return files[:taken]


def read_named_head(spark: SparkSession, path, n: int, columns=TRAIN_SOURCE_COLUMNS) -> DataFrame:
    """The first ``n`` rows of by-name CSV files in file order, reading only
    the files that can hold them (rows are counted file by file from the first)."""
    paths = [path] if isinstance(path, str) else list(path)
    # the order of ``order_columns``: by the path as the scan names it
    files = sorted(spark.read.text(paths).inputFiles())

    def named(file: str) -> str:
        # a scan and its listing write the slashes behind the scheme, and blanks, unlike each other
        return urllib.parse.unquote(re.sub("^([a-z0-9]+):/+", r"\1:/", file))

    def count(asked: list[str]) -> dict[str, int]:
        found = read_named_csv(spark, asked, columns, with_order=True).groupBy("_file").count().collect()
        rows = {named(r["_file"]): r["count"] for r in found}      # one row for each file asked for
        return {f: rows.get(named(f), 0) for f in asked}

    chosen = head_files(files, n, count)
    if not chosen:
        return read_named_csv(spark, path, columns).limit(0)
    rows = read_named_csv(spark, chosen, columns, with_order=True)
    return first_n(rows, n, [F.col(c) for c in ORDER_COLUMNS]).select(*columns)


def first_n(df: DataFrame, n: int | None, order: list | None = None) -> DataFrame:
    """The first ``n`` rows in a defined order (``None`` → all rows).

    ``order`` is the list of sort columns (for a file scan, the file order of
    :func:`order_columns`). Plain ``limit`` promises
    no order; ``orderBy(...).limit(n)`` plans a ``TakeOrderedAndProject``: each
    task keeps its own top ``n`` and only those reach the final merge, so the
    cost is one pass plus n rows per task, with no full sort.
    """
    if n is None:
        return df
    if order is None:
        raise ValueError("first_n needs an order; plain limit promises none")
    return df.orderBy(*order).limit(int(n))
