"""Cleaning (C1-C5): column-wise projections; no row is ever removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.sources.schemas import TIMESTAMP_COLUMNS

RENAMES = {"product_name_lenght": "product_name_length",
           "product_description_lenght": "product_description_length"}

KEY_COLUMNS = {
    "category_translation": ["product_category_name", "product_category_name_english"],
    "supplier_costs": ["category"], "storage_costs": ["category"],
    "fulfillment_costs": ["category"], "return_costs": ["category"],
    "products": ["product_category_name"], "orders": ["order_status"],
}

# (column, lowest allowed value, inclusive?) — values outside become NULL.
RANGE_RULES = {
    "products": [("product_weight_g", 0, False), ("product_length_cm", 0, False),
                 ("product_height_cm", 0, False), ("product_width_cm", 0, False),
                 ("product_photos_qty", 0, True)],
    "order_items": [("price", 0, True), ("freight_value", 0, True)],
}


def rename_columns(products: DataFrame) -> DataFrame:
    """Fix the two misspelt product columns (no-op when already fixed)."""
    present = {k: v for k, v in RENAMES.items() if k in products.columns}
    return products.withColumnsRenamed(present) if present else products


def normalise_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """lower(trim(x)); NULL stays NULL."""
    return df.withColumns({c: F.lower(F.trim(F.col(c))) for c in cols if c in df.columns})


def blank_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact '' -> NULL, then parse text timestamps (unparseable -> NULL)
    straight to zone-less timestamps (the text carries no zone, so the wall-clock
    value is kept whatever the session time zone, also inside a clock change). Typed columns pass through."""
    out = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        if c not in types:
            continue
        if isinstance(types[c], T.StringType):
            out[c] = F.nullif(F.col(c), F.lit("")).try_cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def null_out_of_range(df: DataFrame, rules: list[tuple[str, float, bool]]) -> DataFrame:
    """C4: NULL a measurement below its floor (``inclusive``: the floor itself is valid)."""
    out = {}
    for c, floor, inclusive in rules:
        if c in df.columns:
            bad = F.col(c) < floor if inclusive else F.col(c) <= floor
            out[c] = F.when(bad, F.lit(None)).otherwise(F.col(c))
    return df.withColumns(out) if out else df


def clean_table(df: DataFrame, name: str) -> DataFrame:
    """C1-C4 of one base table."""
    if name == "products":
        df = rename_columns(df)
    df = normalise_keys(df, KEY_COLUMNS.get(name, []))
    df = blank_to_null(df, TIMESTAMP_COLUMNS.get(name, []))
    return null_out_of_range(df, RANGE_RULES.get(name, []))


def clean_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """C1-C4 over every base table. C5: the row count of each table is unchanged."""
    return {name: clean_table(df, name) for name, df in raw.items()}
