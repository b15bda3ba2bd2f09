"""Incremental daily aggregates over arriving transactions / sessions.

The daily sales chart (Q20) and the view side of the daily product metrics
(Q38) are tumbling one-day windows, so they run unchanged as Structured
Streaming aggregations: a watermark on the event time bounds the state (a day's
window is finalised and dropped once the watermark passes its end), and the
sums are exact decimals, as in batch.

Sources are file streams (new Parquet/JSON files landing in a folder); the
returned DataFrames are streaming and are started with :func:`start`.

Two things differ from batch by the nature of a watermark: rows that arrive
later than it allows are dropped, and in append mode a day comes out only when
later data has moved the watermark past its end. Choose the watermark for the
lateness the source can have, and correct older days by the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.functions.columns import MONEY


def _event_time(df: DataFrame, name: str):
    dt = dict(df.dtypes)[name]
    c = F.col(name)
    if dt == "string":
        return F.try_to_timestamp(c)
    return c.cast("timestamp")          # watermarks need a zoned timestamp; session zone is UTC


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def daily_sales_stream(transactions: DataFrame, watermark: str = "2 days") -> DataFrame:
    """(date, daily_sales) per one-day event-time window."""
    ev = transactions.select(_event_time(transactions, "timestamp").alias("event_time"), "total")
    return (ev.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"))
            .agg(F.sum(F.col("total").cast(MONEY)).alias("s"))
            .select(F.to_date(F.col("w.start")).alias("date"),
                    F.col("s").cast("double").alias("daily_sales")))


def daily_product_views_stream(sessions: DataFrame, watermark: str = "1 day") -> DataFrame:
    """(product_id, date, view_count) from page views as sessions arrive."""
    pv = (sessions.select(F.inline("page_views"))
          .filter(F.col("product_id").isNotNull()))
    ev = pv.select(_event_time(pv, "timestamp").alias("event_time"), "product_id")
    return (ev.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"), "product_id")
            .agg(F.count(F.lit(1)).alias("view_count"))
            .select("product_id", F.to_date(F.col("w.start")).alias("date"), "view_count"))


def daily_product_sales_stream(transactions: DataFrame, watermark: str = "2 days") -> DataFrame:
    """(product_id, date, units_sold, revenue) from transaction lines as
    transactions arrive - the sales side of the daily product metrics."""
    lines = transactions.select(_event_time(transactions, "timestamp").alias("event_time"),
                                F.inline("items"))
    return (lines.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"), "product_id")
            .agg(F.sum("quantity").alias("units_sold"),
                 F.sum(F.col("subtotal").cast(MONEY)).alias("revenue"))
            .select("product_id", F.to_date(F.col("w.start")).alias("date"), "units_sold",
                    F.col("revenue").cast("double").alias("revenue")))


def start(stream_df: DataFrame, sink_path: str, checkpoint: str, output_mode: str = "append",
          available_now: bool = False, fmt: str = "parquet") -> StreamingQuery:
    """Start a query writing finalised windows to files; the checkpoint folder
    (shared storage) makes the query restartable after a failure."""
    w = (stream_df.writeStream.outputMode(output_mode).format(fmt)
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
