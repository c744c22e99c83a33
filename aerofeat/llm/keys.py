"""One integer key per document, and tables staged in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, stage

KEY = "_key"


def keyed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(``_key`` long, ``doc_id``, ``text``, ``keep``...), one row per document.

    A document is a distinct (doc_id, text); ``_key`` orders documents by
    doc_id (null last), then by a hash of the text. Where every doc_id is
    there, a whole number, and stands once, it is the key itself: only the ids are shuffled to
    find out. Otherwise the keys come from a range sort of (doc_id, hash of
    the text) written to the shared folder, and repeated rows become one.
    Ids of any type that sorts are taken.

    A table of just ``_key``, ``doc_id`` and ``text`` has its keys already and
    is returned as it is."""
    if docs.columns == [KEY, "doc_id", "text"]:
        return docs
    d = docs.select("doc_id", "text", *keep)
    whole = isinstance(d.schema["doc_id"].dataType, T.IntegralType)
    most, gaps = d.groupBy("doc_id").count().agg(
        F.max("count"), F.max(F.col("doc_id").isNull())).first() if whole else (2, True)
    if most in (None, 1) and not gaps:
        # the filter drops nothing; with it, inner and outer joins read one and the same shuffle
        return d.filter(F.col("doc_id").isNotNull()).select(
            F.col("doc_id").cast("long").alias(KEY), "doc_id", "text", *keep)
    d = d.withColumn("_th", F.xxhash64("text"))
    ids = stage(d.select("doc_id", "_th").distinct().sort(F.asc_nulls_last("doc_id"), "_th")
                .withColumn(KEY, F.monotonically_increasing_id()), "keys")
    ids = ids.withColumnsRenamed({"doc_id": "_id", "_th": "_h"})
    return d.join(ids, d["doc_id"].eqNullSafe(ids["_id"]) & (d["_th"] == ids["_h"])) \
        .dropDuplicates([KEY]).select(KEY, "doc_id", "text", *keep)


__all__ = ["KEY", "keyed", "scratch_path", "stage"]
