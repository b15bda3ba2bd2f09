"""Q5-Q6: products bought together / viewed together.

The counts are those of an equi self-join of the basket lines on the basket id
with ``a < b``: a product that stands m times in a basket counts m times, rows
that repeat a basket id are one basket, and rows without an id join nothing.

Plan: each row's lines are cut into chunks in the row; the chunks are joined
with themselves on the basket id, and each pair of chunks yields its product
pairs inside the row. An ordinary basket is one chunk, so what is shuffled is
one row per basket, once (both join sides read the same exchange), and the
pairs are partially aggregated before their own shuffle. A huge basket is many
chunk pairs, which Spark's skew-join handling spreads over tasks. The result
does not depend on the chunk size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_LINES = 64


def basket_pair_counts(baskets: DataFrame, basket_col: str, ids_col: str, count_name: str,
                       chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """(product_a, product_b, count) over baskets given as (basket id, array of product ids)."""
    ids = F.array_compact(ids_col)
    starts = F.sequence(F.lit(1), F.size("ids"), F.lit(chunk_lines))
    chunks = (baskets.select(F.col(basket_col).alias("basket"), ids.alias("ids"))
              .filter(F.col("basket").isNotNull() & (F.size("ids") > 0))
              .select("basket", F.explode(F.transform(
                  starts, lambda i: F.slice("ids", i, chunk_lines))).alias("chunk")))
    left, right = chunks.withColumnRenamed("chunk", "x"), chunks.withColumnRenamed("chunk", "y")
    pairs = F.flatten(F.transform("x", lambda a: F.transform(
        F.filter("y", lambda b: a < b), lambda b: F.struct(a.alias("product_a"), b.alias("product_b")))))
    # a sort-merge join whatever the size: both sides are then one scan and one exchange
    return (left.join(right.hint("merge"), "basket").select(F.inline(pairs))
            .groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias(count_name)))


def _enrich(pairs: DataFrame, products_clean: DataFrame, count_name: str) -> DataFrame:
    names = products_clean.select("product_id", "name")
    a = names.select(F.col("product_id").alias("product_a"), F.col("name").alias("product_a_name"))
    b = names.select(F.col("product_id").alias("product_b"), F.col("name").alias("product_b_name"))
    return (pairs.join(a, "product_a").join(b, "product_b")
            .select("product_a", "product_a_name", "product_b", "product_b_name", count_name)
            .orderBy(F.desc(count_name), "product_a", "product_b"))


def bought_together(transactions_clean: DataFrame, products_clean: DataFrame, **kw) -> DataFrame:
    baskets = transactions_clean.select(
        "transaction_id", F.col("items.product_id").alias("ids"))
    pairs = basket_pair_counts(baskets, "transaction_id", "ids", "bought_together_count", **kw)
    return _enrich(pairs, products_clean, "bought_together_count")


def viewed_together(sessions_clean: DataFrame, products_clean: DataFrame, **kw) -> DataFrame:
    baskets = sessions_clean.select("session_id", F.col("viewed_products").alias("ids"))
    pairs = basket_pair_counts(baskets, "session_id", "ids", "viewed_together_count", **kw)
    return _enrich(pairs, products_clean, "viewed_together_count")
