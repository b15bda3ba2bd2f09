"""SQL text over the registered views gives the operators' results."""

from pyspark.sql import functions as F

from cartwheel.operators import products, sessions as sess
from cartwheel.sources.catalog import Shop

SF = "/root/testdata/sf0.01"


def test_sql_over_cleaned_views_matches_operators(spark):
    shop = Shop.from_testdata(spark, SF)
    shop.register_views(cleaned=True)
    funnel_sql = spark.sql("""
        SELECT conversion_status, device_profile.type AS device_type, count(*) AS session_count,
               count(DISTINCT user_id) AS unique_users
        FROM sessions GROUP BY conversion_status, device_profile.type""")
    c = shop.cleaned()
    funnel_df = sess.session_funnel(c.sessions).select(
        "conversion_status", "device_type", "session_count", "unique_users")
    assert funnel_sql.exceptAll(funnel_df).count() == 0 and funnel_df.exceptAll(funnel_sql).count() == 0

    units_sql = spark.sql("""
        SELECT it.product_id AS product_id, sum(it.quantity) AS total_quantity_sold
        FROM (SELECT explode(items) AS it FROM transactions) GROUP BY it.product_id""")
    units_df = (products.product_sales(c.transactions)
                .select("product_id", F.col("total_quantity_sold")))
    assert units_sql.exceptAll(units_df).count() == 0 and units_df.exceptAll(units_sql).count() == 0
