"""Training-set preparation: completed flights, label, date split.

Input is the by-name training source (string or numeric columns Cancelled,
Diverted, DepDelay, TaxiOut, Distance, ArrDelay, FlightDate). All steps are
same-row expressions on one DataFrame: the train and test sets are two
filters of one projection, no join.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import flight as ff
from ..schemas import TRAIN_FEATURES

# --- fixed values -----------------------------------------------------------
DEFAULT_SPLIT_DATE = "2020-05-20"
# ---------------------------------------------------------------------------


class Split(NamedTuple):
    train: DataFrame
    test: DataFrame


def _num(source: DataFrame, c: str):
    """Column ``c`` as double: text is converted leniently (null when it is
    no number); a numeric column is cast directly."""
    if isinstance(source.schema[c].dataType, T.NumericType):
        return F.col(c).cast("double")
    return ff.to_double(F.col(c).cast("string"))


def completed_flights(source: DataFrame, keep: tuple = ()) -> DataFrame:
    """Rows neither cancelled nor diverted (a missing flag counts as not set),
    with the training columns converted to double."""
    done = ff.completed(_num(source, "Cancelled"), _num(source, "Diverted"))
    return source.filter(done).select(
        *keep, *[_num(source, c).alias(c) for c in TRAIN_FEATURES],
        _num(source, "ArrDelay").alias("ArrDelay"),
        F.col("FlightDate").cast("string").alias("FlightDate"))


def labelled(source: DataFrame, keep: tuple = ()) -> DataFrame:
    """Completed flights with the features and ``target`` = arrives > 15 min
    late (missing delay → false), plus FlightDate for the split."""
    done = completed_flights(source, keep)
    return done.select(*keep, *TRAIN_FEATURES, ff.late_arrival(F.col("ArrDelay")).alias("target"),
                       "FlightDate")


def split_by_date(source: DataFrame, split_date: str = DEFAULT_SPLIT_DATE,
                  keep: tuple = ()) -> Split:
    """Train = FlightDate < split_date, test = FlightDate >= split_date, by
    string order of the date text (a null date is in neither set)."""
    lab = labelled(source, keep)
    cols = [*keep, *TRAIN_FEATURES, "target"]
    d = F.lit(split_date)
    return Split(lab.filter(F.col("FlightDate") < d).select(*cols),
                 lab.filter(F.col("FlightDate") >= d).select(*cols))
