"""Adapter from the driver's star-schema test tables to the shop's document shapes.

The mapping (see FIXTURES.md §2):

* users        <- customer (+ nation/region names as state/city and country)
* products     <- part (category = brand)
* categories   <- distinct brands
* transactions <- orders with their lineitems nested as ``items``
* sessions     <- events, one session per (user, calendar day)

Ids stay ``bigint`` so comparisons and ``a < b`` pair order match the SQL
oracle. Everything here is lazy DataFrame code; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import money, money_sum, whole_seconds
from cartwheel.operators.timeline import row_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed values of the adapter: device type by user_id % 3.
DEVICE_BY_MOD3 = ("mobile", "desktop", "tablet")

#: Parquet bytes of lines whose orders are put together in one task (half a million lines, or some 250 MB there)
TASK_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def by_key(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The table dealt to tasks by ``key``, as many as its files' size asks for: a task's memory does not
    grow with the input, whatever number of shuffle partitions the session has."""
    table = read_table(spark, sf_dir, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    if size <= TASK_BYTES:
        return table.repartition(key)  # few rows: Spark chooses
    return table.repartition(max(-(-size // TASK_BYTES), spark.sparkContext.defaultParallelism), key)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    # nation (25 rows) and region (5 rows) have a fixed size: safe to broadcast
    n = F.broadcast(read_table(spark, sf_dir, "nation"))
    r = F.broadcast(read_table(spark, sf_dir, "region"))
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        "n_nationkey", "n_name", "r_name")
    return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey").alias("user_id"),
                    F.struct(F.col("n_name").alias("city"),
                             F.col("n_name").alias("state"),
                             F.col("r_name").alias("country")).alias("geo_data"),
                    F.lit(None).cast("timestamp_ntz").alias("registration_date"),
                    F.lit(None).cast("timestamp_ntz").alias("last_active")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("category_id"),
        F.col("p_retailprice").alias("base_price"),
        F.col("p_size").cast("int").alias("current_stock"),
        F.lit(None).cast("boolean").alias("is_active"),
        F.lit(None).cast("array<struct<price:double,date:timestamp_ntz>>").alias("price_history"),
        F.lit(None).cast("timestamp_ntz").alias("creation_date"))


def product_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a price history: the lowest unit price of each month in which
    the part was ordered (a history grows with the months, not with the orders)."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    monthly = (li.join(o, li.l_orderkey == o.o_orderkey)
               .select(F.col("l_partkey").alias("product_id"), F.trunc("o_orderdate", "month").cast("timestamp_ntz").alias("date"),
                       F.try_divide("l_extendedprice", "l_quantity").alias("price"))
               .groupBy("product_id", "date").agg(F.min("price").alias("price")))
    history = monthly.groupBy("product_id").agg(F.collect_list(F.struct("price", "date")).alias("price_history"))
    return products(spark, sf_dir).drop("price_history").join(history, "product_id", "left")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return (p.select(F.col("p_brand").alias("category_id")).distinct()
            .select("category_id", F.col("category_id").alias("name"),
                    F.lit(None).cast(
                        "array<struct<subcategory_id:string,name:string,profit_margin:double>>"
                    ).alias("subcategories")))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    # one row per order: its lines in line-number order (an order has a handful
    # of lines, so the collected array is small by construction)
    # hash-partition the lines by order first: the collect then runs in every
    # shuffle partition (a collect_list has nothing to pre-aggregate map-side)
    lines = (by_key(spark, sf_dir, "lineitem", "l_orderkey").groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(
                      F.col("l_linenumber").alias("ln"),
                      F.col("l_partkey").alias("product_id"),
                      F.col("l_quantity").cast("int").alias("quantity"),
                      F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
                      F.col("l_extendedprice").alias("subtotal")))).alias("lines"),
                  money_sum("l_extendedprice").alias("items_subtotal"),
                  money_sum(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).alias("line_discounts")))
    # even orders: what was taken off up to the stored total; odd ones: the lines' own discounts
    taken_off = (money("items_subtotal") - money("o_totalprice")).cast("double")
    discount = F.when(F.col("o_orderkey") % 2 == 0, taken_off).otherwise(F.col("line_discounts"))
    # a session of the customer in January 2024, which may exist or not; every fifth order has none
    session_day = F.lpad((F.col("o_orderkey") % 31 + 1).cast("string"), 2, "0")
    session_id = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit("_202401"), session_day))
    items = F.transform("lines", lambda x: F.struct(
        x.product_id.alias("product_id"), x.quantity.alias("quantity"),
        x.unit_price.alias("unit_price"), x.subtotal.alias("subtotal")))
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("transaction_id"),
                    session_id.alias("session_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.col("o_orderdate").alias("timestamp"),
                    F.coalesce(items, F.array_compact(F.array(F.lit(None).cast(
                        "struct<product_id:bigint,quantity:int,unit_price:double,subtotal:double>"
                    )))).alias("items"),
                    F.coalesce(F.col("items_subtotal"), F.lit(0.0)).alias("subtotal"),
                    F.coalesce(discount, F.lit(0.0)).alias("discount"),
                    F.col("o_totalprice").alias("total"),
                    F.col("o_orderpriority").alias("payment_method"),
                    F.col("o_orderstatus").alias("status")))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by session (user, calendar day), product id parsed from props."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", "event_type",
                     F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
                     F.to_date("ts").alias("session_date"))


def session_id_col(user_id="user_id", day="session_date"):
    return F.concat_ws("_", F.col(user_id).cast("string"), F.date_format(F.col(day), "yyyyMMdd"))


def session_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a put of its session's state under the key of (user, day), in the order of event_id."""
    ev = event_rows(spark, sf_dir)
    day = F.col("session_date").cast("timestamp_ntz")
    return ev.select(row_key(F.col("user_id"), day).alias("row_key"), "user_id", F.col("event_id").alias("put_seq"),
                     F.col("ts").alias("last_event_time"), F.col("event_type").alias("last_event_type"),
                     F.col("k").alias("last_product_id"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the price a clicked product is put into the cart at joins the event itself, so
    # the events are read once and a session's whole state is one collected array
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    ev = event_rows(spark, sf_dir)
    click = F.when(F.col("event_type") == "click", F.col("k"))
    pv = ev.withColumn("clicked", click).join(part, F.col("clicked") == F.col("p_partkey"), "left")
    key = ["user_id", "session_date"]
    view_pid = F.when(F.col("event_type") == "view", F.col("k"))
    body = pv.groupBy(*key).agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.array_sort(F.collect_list(F.struct(
            F.col("ts"), F.col("event_id"), F.col("event_type"), view_pid.alias("pid"),
            F.col("clicked"), F.col("p_retailprice").alias("price")))).alias("pv"),
        F.bool_or(F.col("event_type") == "purchase").alias("has_purchase"),
        F.bool_or(F.col("event_type") == "click").alias("has_click"))
    # clicks sorted by product: a run of one product is a cart line
    clicks = F.array_sort(F.transform(F.filter("pv", lambda x: x.clicked.isNotNull()),
                                      lambda x: F.struct(x.clicked.alias("k"), x.price.alias("price"))))
    first = F.filter(F.transform("clicks", lambda x, i: F.struct(
        x.k.alias("k"), x.price.alias("price"), i.alias("i"),
        ((i == 0) | (F.get("clicks", i - 1).k != x.k)).alias("opens"))), lambda x: x.opens)
    lines = F.transform("firsts", lambda x, j: F.struct(x.k.alias("k"), F.struct(
        (F.coalesce(F.get("firsts", j + 1).i, F.size("clicks")) - x.i).cast("int").alias("quantity"),
        x.price.alias("price"))))
    body = (body.withColumn("clicks", clicks).withColumn("firsts", first)
            .withColumn("cart_contents", F.when(F.size("clicks") > 0, F.map_from_entries(lines))))

    u = users(spark, sf_dir).select("user_id", "geo_data")
    device = (F.when(F.pmod("user_id", F.lit(3)) == 0, F.lit(DEVICE_BY_MOD3[0]))
              .when(F.pmod("user_id", F.lit(3)) == 1, F.lit(DEVICE_BY_MOD3[1]))
              .otherwise(F.lit(DEVICE_BY_MOD3[2])))
    # view_duration: whole seconds to the next event of the session (0 for the
    # last), read from the sorted array in-row - no window over all events
    page_views = F.transform("pv", lambda x, i: F.struct(
        x.ts.alias("timestamp"), x.event_type.alias("page_type"), x.pid.alias("product_id"),
        F.lit(None).cast("string").alias("category_id"),
        F.coalesce(whole_seconds(x.ts, F.try_element_at(F.col("pv"), i + 2).ts), F.lit(0))
         .alias("view_duration")))
    return (body.join(u, "user_id", "left")
            .select(session_id_col().alias("session_id"),
                    "user_id", "start_time", "end_time",
                    whole_seconds("start_time", "end_time").alias("duration_seconds"),
                    F.struct(F.col("geo_data.city").alias("city"),
                             F.col("geo_data.state").alias("state"),
                             F.col("geo_data.country").alias("country"),
                             F.lit(None).cast("string").alias("ip_address")).alias("geo_data"),
                    F.struct(device.alias("type"), F.lit(None).cast("string").alias("os"),
                             F.lit(None).cast("string").alias("browser")).alias("device_profile"),
                    # distinct viewed products, derived in-row from the one collected array
                    F.array_sort(F.array_distinct(F.filter(F.col("pv.pid"), lambda p: p.isNotNull())))
                     .alias("viewed_products"),
                    page_views.alias("page_views"),
                    "cart_contents",
                    F.when(F.col("has_purchase"), F.lit("converted"))
                     .when(F.col("has_click"), F.lit("abandoned"))
                     .otherwise(F.lit("browsed")).alias("conversion_status"),
                    F.lit(None).cast("string").alias("referrer")))
