"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.sources.load import read_checked
from skuflow.sources.schemas import DEMAND_SERIES_SCHEMA, FORECAST_SCHEMA, RAW_SCHEMAS, check_schema


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Load one base table with its declared schema (CSV) or check it (parquet). A CSV record that does
    not fit fails the load, as a database load does; `load.read_checked` sets such records aside instead."""
    if fmt == "csv":
        rows, quarantine = read_checked(spark, path, table)
        bad = quarantine.limit(1).collect()
        if bad:
            raise ValueError(f"table {table}: {', '.join(bad[0]['problems'])} in record {bad[0]['line'][:200]}")
        return rows
    return check_schema(spark.read.format(fmt).load(path), table)


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {t: read_table(spark, f"{root}/{t}", t, fmt) for t in RAW_SCHEMAS}


def read_demand_series(spark: SparkSession, path: str) -> DataFrame:
    """SKU x month series (CSV with header); extra columns are ignored. The month
    may be written ``yyyy-MM`` or ``yyyy-MM-dd`` and comes out as ``yyyy-MM``;
    `Pipeline.from_demand_series` takes the result."""
    df = spark.read.option("header", True).csv(path)
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in DEMAND_SERIES_SCHEMA.fields])
    return out.withColumn("order_month", month_text("order_month"))


def month_text(column: str) -> Column:
    day = F.when(F.length(column) == 7, F.concat(column, F.lit("-01"))).otherwise(F.col(column))
    return F.date_format(F.to_date(day, "yyyy-MM-dd"), "yyyy-MM")


def write_demand_series(monthly_sku: DataFrame, path: str, fmt: str = "csv") -> None:
    """S3: export the monthly series sorted by SKU and month."""
    out = monthly_sku.select("product_id", "category", "order_month", "units_sold") \
        .orderBy("product_id", "order_month")
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_forecasts(forecasts: DataFrame, path: str) -> None:
    """Forecast rows partitioned by grain, so readers prune to one grain."""
    forecasts.select(*[f.name for f in FORECAST_SCHEMA.fields]) \
        .write.mode("overwrite").partitionBy("grain").parquet(path)


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in FORECAST_SCHEMA.fields])
