"""Renewal of a stored forecast table for changed series only (S4 with M10, M11).

Every gap-filled series has a digest of its months, units and category and of the model's
settings, stored beside its forecast rows. A renewal fits only series whose digest is new:
an anti-join of the current digests with the stored ones finds them, and series that are
gone are found the other way round. The table is laid out in partitions of (grain, bucket of
the key's hash); only the partitions that hold a changed or removed series are rewritten
(dynamic partition overwrite), with the unchanged rows of those partitions as they were.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.params import ForecastParams
from skuflow.session import delete_stages, materialize, path_exists
from skuflow.sources.schemas import FORECAST_SCHEMA

BUCKETS = 64
KEY = ["grain", "grain_key"]
_COLUMNS = [f.name for f in FORECAST_SCHEMA.fields]


@dataclass(frozen=True)
class Renewal:
    """What a renewal did: series fitted, removed, left as they were, and partitions rewritten."""

    fitted: int
    removed: int
    unchanged: int
    partitions: int


def series_digests(filled: DataFrame, model: str, p: ForecastParams = ForecastParams()) -> DataFrame:
    """(grain, grain_key, digest) of every series long enough to be forecast. A group holds one series' months."""
    points = F.sort_array(F.collect_list(F.struct("t", F.col("month").cast("string").alias("month"), F.col("units").cast("string").alias("units"))))
    text = F.concat_ws("|", F.lit(model), F.lit(repr(p)), F.max("category"), F.to_json(points))
    return filled.where(F.col("n") >= p.min_len).groupBy(*KEY).agg(F.sha2(text, 256).alias("digest"))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("grain_key"), F.lit(buckets)).cast("int").alias("bucket")


def read_renewed(spark: SparkSession, path: str) -> DataFrame:
    """The forecast table of a renewed store."""
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in FORECAST_SCHEMA.fields])


def renew_forecasts(filled: DataFrame, path: str, forecaster: Callable[[DataFrame], DataFrame], model: str,
                    p: ForecastParams = ForecastParams(), buckets: int = BUCKETS) -> Renewal:
    """Bring the store at ``path`` up to date with the gap-filled series ``filled`` (M4). ``forecaster``
    makes forecast rows of the series it is given; ``model`` names it (and its settings)."""
    spark, stages = filled.sparkSession, []
    now = materialize(series_digests(filled, model, p).select(*KEY, "digest", _bucket(buckets)), "renew-digests", stages)
    if path_exists(spark, path):
        old = spark.read.parquet(path)
        held = old.select(*KEY, "digest", "bucket").distinct()
    else:
        old = None
        held = now.limit(0)
    changed = materialize(now.join(held, [*KEY, "digest"], "left_anti"), "renew-changed", stages)
    removed = held.join(now, KEY, "left_anti")
    parts = materialize(changed.select("grain", "bucket").unionByName(removed.select("grain", "bucket")).distinct(), "renew-parts", stages)   # at most 2 x buckets
    fitted, total, gone, touched = changed.count(), now.count(), removed.count(), parts.count()
    if touched:
        fresh = forecaster(filled.join(changed.select(*KEY), KEY, "left_semi")).select(*_COLUMNS).join(changed, KEY)
        if old is not None:
            same = now.join(changed, [*KEY, "digest"], "left_anti").select(*KEY)
            kept = old.join(F.broadcast(parts), ["grain", "bucket"], "left_semi").join(same, KEY, "left_semi")
            fresh = fresh.unionByName(kept.select(*fresh.columns))
        fresh = materialize(fresh, "renew-rows", stages)
        left = fresh.select("grain", "bucket").distinct()
        emptied = [f"{path}/grain={r['grain']}/bucket={r['bucket']}" for r in parts.join(F.broadcast(left), ["grain", "bucket"], "left_anti").collect()]
        (fresh.repartition("grain", "bucket").sortWithinPartitions("grain", "bucket", "grain_key", "forecast_month")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("grain", "bucket").parquet(path))
        delete_stages(spark, emptied)                   # partitions that lost their last series
    delete_stages(spark, stages)
    return Renewal(fitted, gone, total - fitted, touched)
