"""Explicit schemas of the five shop datasets as they arrive as JSON documents.

Timestamps arrive as ISO-8601 strings and are parsed by the cleaning
operators; the shapes (nesting, arrays, the cart map) are fixed here so no
read ever infers a schema. ``cart_contents`` is a map keyed by product id:
inference would turn it into a struct with one field per product id.
"""

from pyspark.sql import types as T

GEO = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
])

SESSION_GEO = T.StructType(GEO.fields + [T.StructField("ip_address", T.StringType())])

DEVICE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("browser", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("geo_data", GEO),
    T.StructField("registration_date", T.StringType()),
    T.StructField("last_active", T.StringType()),
])

CATEGORIES = T.StructType([
    T.StructField("category_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("subcategories", T.ArrayType(T.StructType([
        T.StructField("subcategory_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("profit_margin", T.DoubleType()),
    ]))),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category_id", T.StringType()),
    # kept as text so a bad value ("abc") is dropped by cleaning, not by the reader
    T.StructField("base_price", T.StringType()),
    T.StructField("current_stock", T.IntegerType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("price_history", T.ArrayType(T.StructType([
        T.StructField("price", T.DoubleType()),
        T.StructField("date", T.StringType()),
    ]))),
    T.StructField("creation_date", T.StringType()),
])

PAGE_VIEW = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("page_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("view_duration", T.IntegerType()),
])

CART_LINE = T.StructType([
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
])

SESSIONS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("duration_seconds", T.IntegerType()),
    T.StructField("geo_data", SESSION_GEO),
    T.StructField("device_profile", DEVICE),
    T.StructField("viewed_products", T.ArrayType(T.StringType())),
    T.StructField("page_views", T.ArrayType(PAGE_VIEW)),
    T.StructField("cart_contents", T.MapType(T.StringType(), CART_LINE)),
    T.StructField("conversion_status", T.StringType()),
    T.StructField("referrer", T.StringType()),
])

ITEM = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("subtotal", T.DoubleType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("subtotal", T.DoubleType()),
    # generated as int 0 or a float; a double holds both
    T.StructField("discount", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
])

BY_NAME = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "sessions": SESSIONS,
    "transactions": TRANSACTIONS,
}
