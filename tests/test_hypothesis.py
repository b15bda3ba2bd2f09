"""Property-based checks of the exact building blocks against brute force."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.functions.columns import div_half_up
from cartwheel.operators import baskets

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

basket_lists = st.lists(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=9), min_size=1,
                        max_size=8)


@SETTINGS
@given(rows=basket_lists, chunk=st.integers(1, 6))
def test_pair_counts_equal_brute_force(spark, rows, chunk):
    df = spark.createDataFrame([(i, ids) for i, ids in enumerate(rows)], "bid int, ids array<int>")
    got = {(r.product_a, r.product_b): r.n for r in baskets.basket_pair_counts(
        df, "bid", "ids", "n", chunk_lines=chunk).collect()}
    want: dict = {}
    for ids in rows:
        for x in ids:
            for y in ids:
                if x is not None and y is not None and x < y:
                    want[(x, y)] = want.get((x, y), 0) + 1
    assert got == want


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)),
                      min_size=1, max_size=20), places=st.integers(0, 4))
def test_div_half_up_equals_decimal_rounding(spark, pairs, places):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.x for r in df.select(div_half_up("n", "d", places).alias("x")).collect()]
    q = Decimal(1).scaleb(-places)
    want = [float((Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want
