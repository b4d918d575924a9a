"""Adapter: the driver's TPC-H-like parquet tables -> the e-commerce base tables.

orders -> orders, lineitem -> order_items, part -> products, brands -> categories
with a synthetic cost model, and reviews derived from order keys. Everything is
a projection of the given tables, so the work grows with them. ``dirty=True``
injects the defects the cleaning and quality operators must handle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.session import materialize
from skuflow.sources.schemas import MONEY, MONEY4, RATE

# Fixed values of the mapping (see FIXTURES.md section 3).
CANCELED_MOD, CANCELED_REM = 20, 0
UNAVAILABLE_REM = 1
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
NULL_CATEGORY_MOD = 53
FREIGHT_HEAVY_MOD, FREIGHT_HEAVY_REM, FREIGHT_HEAVY_FACTOR = 25, 4, 30
REVIEW_SCORE_BY_LAST_DIGIT = {0: 1, 1: 2, 2: 3, 3: 4, 4: 4}   # 5..9 -> 5
SECOND_REVIEW_MOD, SECOND_REVIEW_REMS, SECOND_REVIEW_SCORE = 50, (3, 7), 2
SECOND_REVIEW_ID_OFFSET = 1_000_000_000
UNKNOWN_PRODUCT_OFFSET = 1_000_000_000
# dirty variant
DIRTY_STATUS_MOD, DIRTY_TS_MOD, DIRTY_PRICE_MOD, DIRTY_WEIGHT_MOD, DIRTY_PRODUCT_MOD = 11, 97, 211, 41, 499


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _status(key: Column, code: Column) -> Column:
    mapped = F.when(code == "F", STATUS_BY_CODE["F"]).when(code == "O", STATUS_BY_CODE["O"]) \
        .when(code == "P", STATUS_BY_CODE["P"])
    return (F.when(key % CANCELED_MOD == CANCELED_REM, "canceled")
            .when(key % CANCELED_MOD == UNAVAILABLE_REM, "unavailable")
            .otherwise(mapped))


def _category_name(brand: Column) -> Column:
    return F.lower(F.regexp_replace(brand, "#", "_"))


def _brand_number(brand: Column) -> Column:
    return F.substring_index(brand, "#", -1).cast("int")


def categories(part: DataFrame) -> DataFrame:
    """(category, n): one row per brand."""
    return (part.select(_category_name(F.col("p_brand")).alias("category"),
                        _brand_number(F.col("p_brand")).alias("n"))
            .where(F.col("category").isNotNull()).distinct())


def cost_tables(cats: DataFrame, dirty: bool = False) -> dict[str, DataFrame]:
    n = F.col("n")
    cat = F.col("category")
    supplier = cats.select(
        (F.when(n % 4 == 0, F.concat(F.lit(" "), F.upper(cat), F.lit(" "))).otherwise(cat) if dirty else cat)
        .alias("category"),
        F.when(n.isin(1, 2, 3), F.lit("0.02")).otherwise(F.lit(0.45) + F.lit(0.025) * n)
        .cast(RATE).alias("cogs_rate"))
    storage_src = cats
    if dirty:  # one category loses its storage-cost row
        storage_src = cats.where(n != 25)
    storage = storage_src.select(
        cat, F.when(n == 1, F.lit(60000)).otherwise(F.lit(500) + F.lit(150) * (n % 7))
        .cast(MONEY).alias("storage_cost_per_unit"))
    fulfillment = cats.select(
        cat, F.when(n == 3, F.lit(65000)).otherwise(F.lit(1500) + F.lit(500) * (n % 5))
        .cast(MONEY).alias("fulfillment_cost_per_order"))
    returns = cats.select(
        cat,
        F.when(n == 2, F.lit("0.9")).otherwise(F.lit(0.02) + F.lit(0.01) * (n % 6)).cast(RATE).alias("return_rate"),
        F.when(n == 2, F.lit(75000)).otherwise(F.lit(8000)).cast(MONEY).alias("return_cost_per_unit"))
    return {"supplier_costs": supplier, "storage_costs": storage,
            "fulfillment_costs": fulfillment, "return_costs": returns}


def load_tables(spark: SparkSession, sf_dir: str, dirty: bool = False) -> dict[str, DataFrame]:
    """Return the nine raw base tables derived from the driver's parquet files."""
    orders_src = _read(spark, sf_dir, "orders")
    items_src = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part")

    key = F.col("o_orderkey")
    status = _status(key, F.col("o_orderstatus"))
    ts = F.col("o_orderdate")
    if dirty:
        status = F.when(key % DIRTY_STATUS_MOD == 0, F.concat(F.lit("  "), F.upper(status), F.lit(" "))) \
            .otherwise(status)
        ts = F.when(key % DIRTY_TS_MOD == 0, F.lit("")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    null_text = F.lit(None).cast("string")
    orders = orders_src.select(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"), status.alias("order_status"),
        ts.alias("order_purchase_timestamp"), null_text.alias("order_approved_at"),
        null_text.alias("order_delivered_carrier_date"), null_text.alias("order_delivered_customer_date"),
        null_text.alias("order_estimated_delivery_date"))

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    freight = (price * F.col("l_tax").cast("decimal(4,2)")
               * F.when(F.col("l_partkey") % FREIGHT_HEAVY_MOD == FREIGHT_HEAVY_REM, F.lit(FREIGHT_HEAVY_FACTOR))
               .otherwise(F.lit(1))).cast(MONEY4)
    product = F.col("l_partkey")
    if dirty:
        price = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % DIRTY_PRICE_MOD == 0, -price).otherwise(price)
        product = F.when(F.col("l_orderkey") % DIRTY_PRODUCT_MOD == 0, product + UNKNOWN_PRODUCT_OFFSET) \
            .otherwise(product)
    items = items_src.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        product.alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        null_text.alias("shipping_limit_date"), price.cast(MONEY).alias("price"), freight.alias("freight_value"))

    size = F.col("p_size").cast("double")
    weight = size * 150.0
    if dirty:
        weight = F.when(F.col("p_partkey") % DIRTY_WEIGHT_MOD == 0, F.lit(0.0)).otherwise(weight)
    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % NULL_CATEGORY_MOD == 0, null_text)
        .otherwise(_category_name(F.col("p_brand"))).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        (size * 10.0).alias("product_description_lenght"),
        (F.col("p_size") % 5).cast("double").alias("product_photos_qty"),
        weight.alias("product_weight_g"), (size + 10.0).alias("product_length_cm"),
        (size + 2.0).alias("product_height_cm"), (size + 5.0).alias("product_width_cm"))

    # One row per brand (tens of rows); stored once because five small tables derive from it.
    cats = materialize(categories(part), "categories")
    translation = cats.select(F.col("category").alias("product_category_name"),
                              F.col("category").alias("product_category_name_english"))

    digit = key % 10
    score = F.when(digit == 0, 1).when(digit == 1, 2).when(digit == 2, 3).when(digit.isin(3, 4), 4).otherwise(5)
    first = orders_src.where((F.floor(key / 10) % 5) == 0).select(
        key.alias("review_id"), key.alias("order_id"), score.alias("review_score"))
    second = orders_src.where((key % SECOND_REVIEW_MOD).isin(*SECOND_REVIEW_REMS)).select(
        (key + SECOND_REVIEW_ID_OFFSET).alias("review_id"), key.alias("order_id"),
        F.lit(SECOND_REVIEW_SCORE).alias("review_score"))
    reviews = first.unionByName(second).select(
        "review_id", "order_id", F.col("review_score").cast("int"),
        null_text.alias("review_comment_title"), null_text.alias("review_comment_message"),
        null_text.alias("review_creation_date"), null_text.alias("review_answer_timestamp"))

    tables = {"category_translation": translation, "orders": orders, "order_items": items,
              "products": products, "order_reviews": reviews}
    tables.update(cost_tables(cats, dirty))
    return tables


# CSV variant of the items: fixed values of the defects.
CSV_MISSING_MOD, CSV_NUMBER_MOD, CSV_OVERFLOW_MOD, CSV_DATE_MOD, CSV_BLANK_DATE_MOD, CSV_COLUMNS_MOD, CSV_INT_MOD = 43, 37, 61, 41, 29, 47, 59


def write_items_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The items as CSV lines without a header, some of which do not fit: a missing line number, a line number
    that is no whole number, a price that is text or has too many digits, an impossible date, an extra column."""
    key = F.col("l_orderkey")
    number = F.when(key % CSV_MISSING_MOD == 0, "").when(key % CSV_INT_MOD == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(".5x"))) \
        .otherwise(F.col("l_linenumber").cast("string"))
    price = F.when(key % CSV_NUMBER_MOD == 0, "n/a").when(key % CSV_OVERFLOW_MOD == 0, "9" * 20) \
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    date = F.when(key % CSV_DATE_MOD == 0, "2020-13-45 00:00:00").when(key % CSV_BLANK_DATE_MOD == 0, "").otherwise("2020-02-29 12:30:00")
    fields = [key.cast("string"), number, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), date, price, F.lit("1.2500")]
    extra = F.when(key % CSV_COLUMNS_MOD == 0, ",extra").otherwise("")
    _read(spark, sf_dir, "lineitem").select(F.concat(F.concat_ws(",", *fields), extra).alias("value")).write.text(path)


# Every-column variant: fixed values of the defects, by the row's key plus the column's place.
ALL_NULL_TEXT, ALL_BLANK_TEXT, ALL_LOUD_TEXT = 17, 13, 5
ALL_EMPTY_TS, ALL_NO_TS, ALL_NO_DAY_TS, ALL_GAP_TS, ALL_NULL_TS = 7, 11, 23, 29, 31
ALL_RANGE_MOD, ALL_NEGATIVE_REM, ALL_ZERO_REM = 5, 2, 3


def dirty_every_column(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The nine tables with defects in every key, timestamp and range column (C2-C4): keys in capitals
    between blanks, blank or missing; times empty, no date at all, a day that does not exist, an hour that
    daylight saving skips; measurements below and at their floor."""
    from skuflow.operators.clean import KEY_COLUMNS, RANGE_RULES
    from skuflow.sources.schemas import TIMESTAMP_COLUMNS
    number = F.regexp_extract("_key", r"(\d+)$", 1).cast("long")
    row_key = {"orders": F.col("order_id"), "order_items": F.col("order_id") + F.col("order_item_id"), "products": F.col("product_id"),
               "order_reviews": F.col("review_id"), "category_translation": F.col("product_category_name")}
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    out = {}
    for table, df in raw.items():
        keyed = df.withColumn("_key", row_key.get(table, F.col(df.columns[0])).cast("string")).withColumn("_k", number)
        place, made = 0, {}
        for c in KEY_COLUMNS.get(table, []):
            k, place = F.col("_k") + place, place + 1
            made[c] = (F.when(k % ALL_NULL_TEXT == 0, F.lit(None)).when(k % ALL_BLANK_TEXT == 0, "   ")
                       .when(k % ALL_LOUD_TEXT == 0, F.concat(F.lit("  "), F.upper(c), F.lit(" "))).otherwise(F.col(c)))
        for c in TIMESTAMP_COLUMNS.get(table, []):
            k, place = F.col("_k") + place, place + 1
            said = F.concat(F.lit("2016-"), two(k % 12 + 1), F.lit("-"), two(k % 28 + 1), F.lit(" "), two(k % 24), F.lit(":"), two(k % 60), F.lit(":07"))
            made[c] = (F.when(k % ALL_EMPTY_TS == 0, "").when(k % ALL_NO_TS == 0, "not a date").when(k % ALL_NO_DAY_TS == 0, "2020-02-30 00:00:00")
                       .when(k % ALL_GAP_TS == 0, "2017-03-26 02:30:00").when(k % ALL_NULL_TS == 0, F.lit(None)).otherwise(said))
        for c, _, _ in RANGE_RULES.get(table, []):
            k, place = F.col("_k") + place, place + 1
            kind = df.schema[c].dataType
            made[c] = (F.when(k % ALL_RANGE_MOD == ALL_NEGATIVE_REM, -F.col(c)).when(k % ALL_RANGE_MOD == ALL_ZERO_REM, F.lit(0)).otherwise(F.col(c))).cast(kind)
        out[table] = keyed.withColumns(made).select(*df.columns)
    return out
