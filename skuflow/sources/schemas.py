"""Declared schemas of the base tables (S1) and of the forecast table (M9).

Id columns are declared as strings, as in the source system; integral ids are
accepted too (the library never depends on the key type, and integral keys
join and sort faster at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


MONEY = _dec(18, 2)       # per-SKU money values and 2-dp figures
MONEY4 = _dec(18, 4)      # freight as loaded
RATE = _dec(9, 4)         # cost rates
TOTAL = _dec(38, 2)       # portfolio-wide sums
ONE_DP = _dec(18, 1)
FORECAST_NUM = _dec(12, 2)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


RAW_SCHEMAS: dict[str, T.StructType] = {
    "category_translation": T.StructType([
        _f("product_category_name", S, False), _f("product_category_name_english", S)]),
    "supplier_costs": T.StructType([_f("category", S, False), _f("cogs_rate", RATE, False)]),
    "storage_costs": T.StructType([_f("category", S, False), _f("storage_cost_per_unit", MONEY, False)]),
    "fulfillment_costs": T.StructType([
        _f("category", S, False), _f("fulfillment_cost_per_order", MONEY, False)]),
    "return_costs": T.StructType([
        _f("category", S, False), _f("return_rate", RATE, False), _f("return_cost_per_unit", MONEY, False)]),
    "orders": T.StructType([
        _f("order_id", S, False), _f("customer_id", S), _f("order_status", S),
        _f("order_purchase_timestamp", S), _f("order_approved_at", S),
        _f("order_delivered_carrier_date", S), _f("order_delivered_customer_date", S),
        _f("order_estimated_delivery_date", S)]),
    "order_items": T.StructType([
        _f("order_id", S, False), _f("order_item_id", T.IntegerType(), False), _f("product_id", S),
        _f("seller_id", S), _f("shipping_limit_date", S), _f("price", MONEY), _f("freight_value", MONEY4)]),
    "products": T.StructType([
        _f("product_id", S, False), _f("product_category_name", S),
        _f("product_name_lenght", D), _f("product_description_lenght", D), _f("product_photos_qty", D),
        _f("product_weight_g", D), _f("product_length_cm", D), _f("product_height_cm", D),
        _f("product_width_cm", D)]),
    "order_reviews": T.StructType([
        _f("review_id", S, False), _f("order_id", S), _f("review_score", T.IntegerType()),
        _f("review_comment_title", S), _f("review_comment_message", S),
        _f("review_creation_date", S), _f("review_answer_timestamp", S)]),
}

FORECAST_SCHEMA = T.StructType([
    _f("grain", S, False), _f("grain_key", S, False), _f("category", S),
    _f("forecast_month", T.DateType(), False),
    _f("predicted_units", FORECAST_NUM), _f("lower_bound", FORECAST_NUM), _f("upper_bound", FORECAST_NUM),
    _f("mae", FORECAST_NUM), _f("mape_pct", FORECAST_NUM), _f("model_used", S), _f("confidence", S),
])

DEMAND_SERIES_SCHEMA = T.StructType([
    _f("product_id", S), _f("category", S), _f("order_month", S), _f("units_sold", T.LongType()),
])

ID_COLUMNS = {"order_id", "customer_id", "product_id", "seller_id", "review_id"}
TIMESTAMP_COLUMNS = {
    "orders": ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["shipping_limit_date"],
    "order_reviews": ["review_creation_date", "review_answer_timestamp"],
}


def _compatible(name: str, declared: T.DataType, actual: T.DataType, table: str) -> bool:
    if type(declared) is type(actual) and declared == actual:
        return True
    if name in ID_COLUMNS and isinstance(actual, (T.StringType, T.IntegralType)):
        return True
    if name in TIMESTAMP_COLUMNS.get(table, ()):  # text or already parsed
        return isinstance(actual, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType))
    if isinstance(declared, T.DecimalType):
        return isinstance(actual, (T.DecimalType, T.FloatType, T.DoubleType, T.IntegralType))
    if isinstance(declared, (T.DoubleType, T.IntegerType)):
        return isinstance(actual, (T.NumericType,))
    return False


def check_schema(df: DataFrame, table: str) -> DataFrame:
    """Raise when a required column is missing or has an incompatible type."""
    declared = RAW_SCHEMAS[table]
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in declared.fields:
        if field.name not in actual:
            # the two misspelt product columns may arrive already renamed
            fixed = field.name.replace("lenght", "length")
            if fixed in actual:
                continue
            problems.append(f"missing {field.name}")
        elif not _compatible(field.name, field.dataType, actual[field.name], table):
            problems.append(f"{field.name}: {actual[field.name].simpleString()} vs {field.dataType.simpleString()}")
    if problems:
        raise ValueError(f"table {table}: " + "; ".join(problems))
    return df
