"""The pipeline does not depend on the id type: text ids (as in the source
schema) give the same decisions as integer ids."""
from pyspark.sql import functions as F

from skuflow.plans.pipeline import Pipeline
from skuflow.sources import testdata

from conftest import SF_SMALL

IDS = {"orders": ["order_id", "customer_id"], "order_items": ["order_id", "product_id", "seller_id"],
       "products": ["product_id"], "order_reviews": ["review_id", "order_id"]}


def test_text_ids_give_same_decisions(spark, pipe):
    raw = testdata.load_tables(spark, SF_SMALL)
    text = {k: (v.withColumns({c: F.col(c).cast("string") for c in IDS[k]}) if k in IDS else v)
            for k, v in raw.items()}
    d_text = Pipeline(spark, text, forecaster="moving_average").sku_decisions()
    assert dict(d_text.dtypes)["product_id"] == "string"
    a = d_text.select(F.col("product_id"), "verdict", "reorder_point", "unit_price")
    b = pipe.sku_decisions().select(F.col("product_id").cast("string"), "verdict", "reorder_point", "unit_price")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
