"""Loading the base tables.

`read_checked` reads a CSV table against its declared schema and keeps every record: one
that does not fit (a field that does not parse, a missing required field, a date that is no
date, a wrong number of columns) goes to a quarantine with the reasons, the others come out
typed. Nothing is nulled silently and nothing is lost.

`store_tables` writes the cleaned tables once, and counts while it writes: rows, nulls,
unknown statuses and what cleaning set to NULL are observed metrics of the write itself, so
the report needs no further scan. Facts are stored in buckets of ``order_id`` and products in
buckets of ``product_id``, sorted inside, so the joins and key checks on these keys move no
row. Buckets pay while they are even: if one holds far more than the mean (a hot key), the
same files are read without their buckets, and Spark shuffles and splits that join as usual.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.operators import clean
from skuflow.params import ALLOWED_STATUSES
from skuflow.session import delete_stages, ensure_checkpoint_dir
from skuflow.sources.schemas import RAW_SCHEMAS, TIMESTAMP_COLUMNS

RAW_LINE = "_line"
BUCKET_KEYS = {"orders": "order_id", "order_items": "order_id", "order_reviews": "order_id", "products": "product_id"}
UNEVEN = 4                          # largest bucket against the mean


# -- records that do not fit (S1) --------------------------------------------------------------------------------


def _problem(field: T.StructField, table: str) -> Column:
    """Why a text field does not fit its declared column; NULL if it does."""
    c, name = F.col(field.name), field.name
    out = None if field.nullable else F.when(c.isNull() | (c == ""), f"{name}: missing")
    kind = T.TimestampNTZType() if name in TIMESTAMP_COLUMNS.get(table, ()) else field.dataType
    if not isinstance(kind, T.StringType):
        bad, text = c.isNotNull() & (c != "") & c.try_cast(kind).isNull(), f"{name}: not {kind.simpleString()}"
        out = F.when(bad, text) if out is None else out.when(bad, text)
    return F.lit(None).cast("string") if out is None else out


def read_checked(spark: SparkSession, path: str, table: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, quarantine) of a CSV table. Rows have the declared columns and types (dates stay text,
    as C3 parses them); an empty field is NULL. The quarantine is (table, problems, line). Both read the
    same files; write them, or use `load_csv`, to read only once."""
    schema = RAW_SCHEMAS[table]
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(RAW_LINE, T.StringType())])
    raw = (spark.read.schema(texts).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE)
           .option("columnPruning", False).csv(path))
    problems = F.array_compact(F.array(F.when(F.col(RAW_LINE).isNotNull(), "columns: wrong number"), *[_problem(f, table) for f in schema.fields]))
    checked = raw.withColumn("_problems", problems)
    rows = checked.where(F.size("_problems") == 0).select(*[F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    line = F.coalesce(F.col(RAW_LINE), F.to_csv(F.struct(*[f.name for f in schema.fields])))
    quarantine = checked.where(F.size("_problems") > 0).select(F.lit(table).alias("table"), F.col("_problems").alias("problems"), line.alias("line"))
    return rows, quarantine


def load_csv(spark: SparkSession, root: str, header: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """The nine tables of ``root``/<table> and one quarantine over all of them."""
    tables, parts = {}, []
    for name in RAW_SCHEMAS:
        tables[name], part = read_checked(spark, f"{root}/{name}", name, header)
        parts.append(part)
    quarantine = parts[0]
    for p in parts[1:]:
        quarantine = quarantine.unionByName(p)
    return tables, quarantine


def quarantine_report(quarantine: DataFrame) -> DataFrame:
    """The quarantine as rows of the Q7 report: records set aside per table (one row a table that has any)."""
    return quarantine.groupBy("table").agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("malformed_records").alias("check"), "table", F.col("violations").cast("long").alias("violations"), F.lit("fail").alias("severity"))


# -- the stored copy ---------------------------------------------------------------------------------------------


def _before(df: DataFrame, table: str) -> dict[str, Column]:
    """What cleaning will set to NULL (C3, C4), counted on the raw rows."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in TIMESTAMP_COLUMNS.get(table, []):
        if isinstance(kinds.get(c), T.StringType):
            out[f"unparsed:{c}"] = F.count_if((F.col(c) != "") & F.col(c).try_cast("timestamp_ntz").isNull())
    for c, floor, inclusive in clean.RANGE_RULES.get(table, []):
        if c in kinds:
            out[f"out_of_range:{c}"] = F.count_if((F.col(c) < floor) if inclusive else (F.col(c) <= floor))
    return out


def _after(table: str) -> dict[str, Column]:
    """Counts of the cleaned rows: Q3-Q5."""
    out = {"rows": F.count(F.lit(1))}
    if table == "orders":
        out["null:order_purchase_timestamp"] = F.count_if(F.col("order_purchase_timestamp").isNull())
        out["unknown:order_status"] = F.count_if(F.col("order_status").isNotNull() & ~F.col("order_status").isin(*ALLOWED_STATUSES))
    if table == "products":
        out["null:product_category_name"] = F.count_if(F.col("product_category_name").isNull())
    return out


@dataclass
class Stored:
    """Cleaned tables as stored, and the counts taken while each was written."""

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)
    written: list[str] = field(default_factory=list)

    def count(self, table: str, what: str) -> int:
        return self.counts[table][what]

    def load_report(self) -> DataFrame:
        """(table, measure, n) of everything counted."""
        rows = [(t, m, int(n)) for t, c in sorted(self.counts.items()) for m, n in sorted(c.items())]
        return self.spark.createDataFrame(rows, "table string, measure string, n long")

    def release(self) -> None:
        """Drop the tables and delete their files."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names.clear()
        delete_stages(self.spark, self.written)


def store_tables(spark: SparkSession, raw: dict[str, DataFrame], buckets: int | None = None, uneven: float = UNEVEN) -> Stored:
    """Clean every table (C1-C4) and store it, one pass over each."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    run, out = uuid.uuid4().hex[:12], Stored(spark)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skuflow-tables/{run}"
    for table, df in raw.items():
        seen = [Observation(f"{run}_{table}_{i}") for i in range(2)]
        before, after = _before(df, table), _after(table)
        if before:
            df = df.observe(seen[0], *[c.alias(n) for n, c in before.items()])
        df = clean.clean_table(df, table).observe(seen[1], *[c.alias(n) for n, c in after.items()])
        path, key = f"{root}/{table}", BUCKET_KEYS.get(table)
        out.written.append(path)
        if key is None:
            df.write.parquet(path)
            out.tables[table] = spark.read.schema(df.schema).parquet(path)
        else:
            name = f"skuflow_{run}_{table}"
            out.names.append(name)
            (df.repartition(buckets, key).write.format("parquet").option("path", path)
             .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
            out.tables[table] = _even(spark, name, path, buckets, uneven)
        out.counts[table] = (seen[0].get if before else {}) | seen[1].get
    return out


def _even(spark: SparkSession, name: str, path: str, buckets: int, uneven: float) -> DataFrame:
    """The bucketed table, or its plain files if one bucket holds more than ``uneven`` times the mean."""
    files = spark.read.parquet(path)
    sizes = files.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    if sizes[0] and sizes[0] > 1000 and sizes[0] > uneven * sizes[1] / buckets:
        logging.getLogger(__name__).warning("%s: largest bucket %d of %d rows; read without buckets", name, sizes[0], sizes[1])
        return files
    return spark.table(name)
