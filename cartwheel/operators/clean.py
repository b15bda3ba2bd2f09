"""Q1-Q4: cleaning of transactions, sessions and products, with a report.

The validity predicates are defined once and used both to filter and to
count, so the report is produced in one aggregation pass per dataset instead
of the repeated ``count()`` jobs of a print-based report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import array_fields, parse_ts


def valid_transaction() -> Column:
    # tested on the items' product_id array: same nullness and length as
    # items, but lets the scan read one nested field instead of every field
    ids = F.col("items.product_id")
    return F.col("user_id").isNotNull() & ids.isNotNull() & (F.size(ids) > 0)


def valid_session() -> Column:
    return (F.col("user_id").isNotNull() & F.col("session_id").isNotNull()
            & F.col("viewed_products").isNotNull() & (F.size("viewed_products") > 0))


def product_price() -> Column:
    # try_cast: a non-numeric price becomes NULL (and is dropped) instead of
    # failing the job under ANSI mode
    return F.col("base_price").try_cast("double")


def valid_product() -> Column:
    return (F.col("product_id").isNotNull() & F.col("category_id").isNotNull()
            & F.col("base_price").isNotNull() & (product_price() > 0))


def clean_transactions(transactions: DataFrame) -> DataFrame:
    return (transactions.filter(valid_transaction())
            .withColumn("timestamp", parse_ts(transactions, "timestamp"))
            .withColumn("transaction_date", F.to_date("timestamp")))


def clean_sessions(sessions: DataFrame) -> DataFrame:
    return (sessions.filter(valid_session())
            .withColumn("start_time", parse_ts(sessions, "start_time"))
            .withColumn("end_time", parse_ts(sessions, "end_time")))


def clean_products(products: DataFrame) -> DataFrame:
    return products.filter(valid_product()).withColumn("base_price", product_price())


def _report_row(df: DataFrame, name: str, valid: Column) -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("before"),
                   F.count_if(F.coalesce(valid, F.lit(False))).alias("after"))
            .select(F.lit(name).alias("dataset"), "before", "after",
                    (F.col("before") - F.col("after")).alias("removed")))


def cleaning_report(transactions: DataFrame, sessions: DataFrame, products: DataFrame) -> DataFrame:
    """One row per dataset: rows before and after cleaning, and rows removed."""
    return (_report_row(transactions, "transactions", valid_transaction())
            .unionByName(_report_row(sessions, "sessions", valid_session()))
            .unionByName(_report_row(products, "products", valid_product())))


LINE_FIELDS = ("product_id", "quantity", "unit_price", "subtotal", "price")


def normalize_transactions(transactions: DataFrame, default_quantity: int = 0,
                           fields: tuple[str, ...] = LINE_FIELDS) -> DataFrame:
    """Coerce a document extract to fixed types with defaults, as column
    expressions: total and discount become doubles (missing -> 0), each line's
    quantity an int (missing -> ``default_quantity``; one consumer used 1, the
    other 0) and its price a double. Generated lines carry ``unit_price``, not
    ``price``, so price falls back to unit_price before the 0 default. Only the
    line ``fields`` named are built, so the scan reads no others."""
    have = transactions.schema["items"].dataType.elementType.fieldNames()
    need = [f for f in have if f in fields or (f == "unit_price" and "price" in fields)]
    zero = F.lit(0.0)

    def line(x):
        number = lambda f: x[f].try_cast("double") if f in have else F.lit(None).cast("double")
        made = {
            "product_id": lambda: x["product_id"],
            "quantity": lambda: F.coalesce(x["quantity"].try_cast("int"), F.lit(default_quantity)),
            "unit_price": lambda: number("unit_price"),
            "subtotal": lambda: number("subtotal"),
            "price": lambda: F.coalesce(number("price"), number("unit_price"), zero)}
        return F.struct(*[made[f]().alias(f) for f in LINE_FIELDS if f in fields])

    return (transactions
            .withColumn("total", F.coalesce(F.col("total").try_cast("double"), zero))
            .withColumn("discount", F.coalesce(F.col("discount").try_cast("double"), zero))
            .withColumn("items", F.transform(array_fields("items", *need), line)))
