"""Streaming daily aggregates equal the batch ones once all data has arrived."""

import os

from cartwheel.operators import sales
from cartwheel.sources.catalog import Shop
from cartwheel.streaming import daily

SF = "/root/testdata/sf0.001"


def _run_update(stream_df, name):
    q = (stream_df.writeStream.outputMode("update").format("memory").queryName(name)
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    return q


def test_daily_sales_stream_matches_batch(spark, scratch):
    landed = Shop.from_testdata(spark, SF).land(os.path.join(scratch, "stream_src"))
    src = os.path.join(scratch, "stream_src", "transactions")
    stream = daily.read_stream(spark, src, landed.transactions.schema, max_files_per_trigger=2)
    _run_update(daily.daily_sales_stream(stream, watermark="36500 days"), "daily_sales_out")
    got = spark.sql("SELECT date, max_by(daily_sales, daily_sales) AS daily_sales "
                    "FROM daily_sales_out GROUP BY date")
    # update mode emits a window again when it changes; sums only grow here
    want = sales.sales_over_time(landed.transactions)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_append_mode_equals_batch_once_later_data_closes_the_days(spark, scratch):
    from pyspark.sql import functions as F
    landed = Shop.from_testdata(spark, SF).land(os.path.join(scratch, "stream_closing"))
    src = os.path.join(scratch, "stream_closing", "sessions")
    out, ck = os.path.join(scratch, "views_out"), os.path.join(scratch, "views_ck")

    def run():
        stream = daily.read_stream(spark, src, landed.sessions.schema)
        daily.start(daily.daily_product_views_stream(stream), out, ck, available_now=True).awaitTermination(120)
        return spark.read.schema("product_id bigint, date date, view_count bigint").parquet(out)

    batch = (landed.sessions.select(F.inline("page_views")).filter(F.col("product_id").isNotNull())
             .groupBy("product_id", F.to_date("timestamp").alias("date"))
             .agg(F.count(F.lit(1)).alias("view_count")))
    want = sorted(map(tuple, batch.collect()))
    # every emitted (product, day) is final
    assert set(map(tuple, run().collect())) <= set(want)
    # a later session moves the watermark on: all earlier days come out; a row behind it is dropped
    first = landed.sessions.filter("size(viewed_products) > 0").limit(1)
    for days in (400, 800, -400):
        later = first.withColumn("page_views", F.transform("page_views", lambda v: v.withField(
            "timestamp", v["timestamp"] + F.make_dt_interval(F.lit(days)))))
        later.write.mode("append").parquet(src)
        got = run()
    assert sorted(t for t in map(tuple, got.collect()) if t[1].year == 2024) == want


def test_daily_product_sales_stream_matches_batch(spark, scratch):
    from pyspark.sql import functions as F
    from cartwheel.operators import metrics
    landed = Shop.from_testdata(spark, SF).land(os.path.join(scratch, "stream_src2"))
    src = os.path.join(scratch, "stream_src2", "transactions")
    stream = daily.read_stream(spark, src, landed.transactions.schema)
    _run_update(daily.daily_product_sales_stream(stream, watermark="36500 days"), "product_sales_out")
    got = spark.sql("SELECT product_id, date, max(units_sold) AS units_sold, max(revenue) AS revenue "
                    "FROM product_sales_out GROUP BY product_id, date")
    want = (metrics.daily_sales(landed.transactions)
            .select("product_id", "date", "units_sold", F.col("revenue_dec").cast("double").alias("revenue")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
