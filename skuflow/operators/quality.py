"""Data-quality report (Q1-Q9) as Spark jobs.

Each check returns one row ``(check, table, violations, severity)``; the
report is their union. ``enforce`` raises when a 'fail' check has violations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.params import ALLOWED_STATUSES

REPORT_COLUMNS = ["check", "table", "violations", "severity"]


def _row(df: DataFrame, check: str, table: str, violations, severity: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table"),
                     violations.cast("long").alias("violations"), F.lit(severity).alias("severity"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
            check: str, table: str) -> DataFrame:
    """Q1/Q2: child rows whose key has no parent; a NULL key counts as orphan. The
    child is counted per key first, so a hot key is one row per task in the join."""
    parents = parent.select(F.col(parent_key).alias("_k")).distinct()
    missing = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).join(parents, "_k", "left_anti")
    return _row(missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")), check, table, F.col("n"), "info")


def null_count(df: DataFrame, column: str, check: str, table: str) -> DataFrame:
    """Q3/Q4."""
    return _row(df.agg(F.count_if(F.col(column).isNull()).alias("n")), check, table, F.col("n"), "info")


def out_of_vocabulary(df: DataFrame, column: str, allowed: Sequence[str], check: str, table: str) -> DataFrame:
    """Q5: non-NULL values outside the allowed list."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
    return _row(df.agg(F.count_if(bad).alias("n")), check, table, F.col("n"), "info")


def cost_coverage(translation: DataFrame, cost_tables: Sequence[DataFrame]) -> DataFrame:
    """Q6: categories (EN name set) lacking any of the cost rows -> hard failure."""
    base = translation.select(F.col("product_category_name_english").alias("category")) \
        .where(F.col("category").isNotNull())
    missing = None
    for i, t in enumerate(cost_tables):
        flag = t.select("category").distinct().withColumn(f"_has{i}", F.lit(True))
        base = base.join(flag, "category", "left")
        cond = F.col(f"_has{i}").isNull()
        missing = cond if missing is None else (missing | cond)
    return _row(base.agg(F.count_if(missing).alias("n")), "cost_coverage_missing",
                "category_translation", F.col("n"), "fail")


def counted_row(df: DataFrame, n: int, check: str, table: str, severity: str = "info") -> DataFrame:
    """A report row from a count that is known already (``df`` gives the session)."""
    return df.sparkSession.createDataFrame([(check, table, int(n), severity)], "check string, table string, violations long, severity string")


def quality_report(t: dict[str, DataFrame], stored=None, quarantine: DataFrame | None = None) -> DataFrame:
    """Q7: the six counts of the post-load checks; only cost coverage fails. With ``stored`` tables
    (`sources.load.store_tables`) the three column counts are those taken while the tables were
    written; ``quarantine`` (`sources.load.load_csv`) adds the records that did not fit, per table."""
    if stored is not None:
        column_counts = [
            counted_row(t["orders"], stored.count("orders", "null:order_purchase_timestamp"), "null_purchase_timestamp", "orders"),
            counted_row(t["orders"], stored.count("products", "null:product_category_name"), "null_product_category", "products"),
            counted_row(t["orders"], stored.count("orders", "unknown:order_status"), "unexpected_order_status", "orders")]
    else:
        column_counts = [
            null_count(t["orders"], "order_purchase_timestamp", "null_purchase_timestamp", "orders"),
            null_count(t["products"], "product_category_name", "null_product_category", "products"),
            out_of_vocabulary(t["orders"], "order_status", ALLOWED_STATUSES, "unexpected_order_status", "orders")]
    checks = [
        orphans(t["order_items"], t["products"], "product_id", "product_id",
                "orphan_items_product_missing", "order_items"),
        orphans(t["order_reviews"], t["orders"], "order_id", "order_id",
                "orphan_reviews_order_missing", "order_reviews"),
        *column_counts,
        cost_coverage(t["category_translation"], [t["supplier_costs"], t["storage_costs"],
                                                  t["fulfillment_costs"], t["return_costs"]]),
    ]
    if quarantine is not None:
        from skuflow.sources.load import quarantine_report
        checks.append(quarantine_report(quarantine))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class DataQualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Raise when any 'fail' check reports violations (a tiny collect: one row per check)."""
    failed = report.where((F.col("severity") == "fail") & (F.col("violations") > 0)).collect()
    if failed:
        detail = ", ".join(f"{r['check']}={r['violations']}" for r in failed)
        raise DataQualityError(f"data-quality gate failed: {detail}")
    return report


def unique_key(df: DataFrame, cols: Sequence[str], table: str, check: str | None = None) -> DataFrame:
    """Q8: rows breaking a primary/unique key: rows with a NULL key part (for a
    primary key) plus rows beyond the first of each duplicated key."""
    null_any = None
    for c in cols:
        cond = F.col(c).isNull()
        null_any = cond if null_any is None else (null_any | cond)
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.first(null_any).alias("_null"))
    agg = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n")).otherwise(F.col("_n") - 1)), F.lit(0)).alias("n"))
    return _row(agg, check or f"unique_{'_'.join(cols)}", table, F.col("n"), "fail")


def unique_non_null(df: DataFrame, column: str, table: str, check: str) -> DataFrame:
    """UNIQUE (NULLs allowed, and not equal to each other)."""
    per_key = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    agg = per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n"))
    return _row(agg, check, table, F.col("n"), "fail")


def foreign_key(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                check: str, table: str) -> DataFrame:
    """Q9: non-NULL child keys with no parent row."""
    parents = parent.select(F.col(parent_key).alias("_k")).distinct()
    missing = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")) \
        .agg(F.count(F.lit(1)).alias("_n")).join(parents, "_k", "left_anti")
    return _row(missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")), check, table, F.col("n"), "fail")


PRIMARY_KEYS = {
    "category_translation": ["product_category_name"],
    "supplier_costs": ["category"], "storage_costs": ["category"],
    "fulfillment_costs": ["category"], "return_costs": ["category"],
    "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "products": ["product_id"], "order_reviews": ["review_id"],
    "forecast_results": ["grain", "grain_key", "forecast_month"],
}

FOREIGN_KEYS = [
    ("products", "product_category_name", "category_translation", "product_category_name"),
    ("supplier_costs", "category", "category_translation", "product_category_name_english"),
    ("storage_costs", "category", "category_translation", "product_category_name_english"),
    ("fulfillment_costs", "category", "category_translation", "product_category_name_english"),
    ("return_costs", "category", "category_translation", "product_category_name_english"),
]


def key_report(t: dict[str, DataFrame]) -> DataFrame:
    """Q8 + Q9 over all ten tables; a table that is not there is an error."""
    absent = sorted(set(PRIMARY_KEYS) - set(t))
    if absent:
        raise DataQualityError(f"key report: no table {', '.join(absent)}")
    parts = [unique_key(t[name], cols, name, f"pk_{name}") for name, cols in PRIMARY_KEYS.items()]
    parts.append(unique_non_null(t["category_translation"], "product_category_name_english",
                                 "category_translation", "uq_category_en"))
    for child, ck, parent, pk in FOREIGN_KEYS:
        parts.append(foreign_key(t[child], ck, t[parent], pk, f"fk_{child}_{ck}", child))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dimension_check(t: dict[str, DataFrame], max_rows: int) -> dict[str, int]:
    """One job over the five category tables: row and duplicate-key counts
    per table (to prove a size bound before broadcasting) and the number of
    translated categories lacking a cost row (the Q6 gate; > 0 fails)."""
    tables = (("category_translation", "product_category_name_english"), ("supplier_costs", "category"),
              ("storage_costs", "category"), ("fulfillment_costs", "category"), ("return_costs", "category"))
    keys = None
    for name, key in tables:
        part = t[name].select(F.lit(name).alias("tbl"), F.col(key).alias("k"))
        keys = part if keys is None else keys.unionByName(part)
    per_table = keys.groupBy("tbl").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("k").alias("distinct"))
    stats = per_table.select(F.concat(F.lit("rows:"), "tbl").alias("key"), F.col("rows").alias("v")).unionByName(
        per_table.select(F.concat(F.lit("dups:"), "tbl").alias("key"), (F.col("rows") - F.col("distinct")).alias("v")))
    is_tr = F.col("tbl") == "category_translation"
    per_cat = keys.where(F.col("k").isNotNull()).groupBy("k").agg(
        F.max(is_tr).alias("translated"), F.count_distinct(F.when(~is_tr, F.col("tbl"))).alias("costs"))
    cov = per_cat.agg(F.count_if(F.col("translated") & (F.col("costs") < len(tables) - 1)).alias("v")) \
        .select(F.lit("coverage").alias("key"), "v")
    out = {r["key"]: int(r["v"]) for r in stats.unionByName(cov).collect()}
    for name, _ in tables:
        out.setdefault(f"rows:{name}", 0)
        out.setdefault(f"dups:{name}", 0)
    return out
