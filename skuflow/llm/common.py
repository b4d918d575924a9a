"""Helpers shared by the training-data operators.

Conventions of the subpackage:

* a null text counts as the empty text;
* operators read only the columns they name and work on private copies of
  them, so further columns (with whatever names) never clash;
* repeated rows stay separate rows unless an operator says otherwise.
"""

from __future__ import annotations

import math
import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import skuflow

# Functions that run in tasks travel by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(skuflow)

#: One word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_for(df: DataFrame, bytes_each: int = 16 << 20) -> int:
    """Partitions for shuffling whole texts: at least the session's setting, and
    enough that one holds about ``bytes_each`` of the (stored) input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    if not hasattr(df, "_jdf"):  # a session type without plan statistics
        return least
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()  # estimates of joins multiply, so what is read counts
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size > 1 << 55:  # unknown
        return least
    return max(least, math.ceil(size / bytes_each))


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    return sys.modules.setdefault("_skuflow_worker", types.ModuleType("_skuflow_worker")).__dict__


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
