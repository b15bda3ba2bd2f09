"""The five shop datasets as one handle, from any of the supported sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DATASETS = ("users", "products", "categories", "transactions", "sessions")


@dataclass
class Shop:
    users: DataFrame
    products: DataFrame
    categories: DataFrame
    transactions: DataFrame
    sessions: DataFrame
    #: products with their price history, where products carry none
    prices: DataFrame | None = None
    #: session states in the order they were put: row_key, user_id, put_seq, ...
    puts: DataFrame | None = None
    #: stored forms, written by land_derived: the flat timeline by key, daily metrics by month,
    #: users' numbers and the bitmaps of each product and day by month
    timeline: DataFrame | None = None
    metrics: DataFrame | None = None
    user_numbers: DataFrame | None = None
    user_bitmaps: DataFrame | None = None

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Shop":
        """Lazy views over the driver's parquet test tables (FIXTURES.md §2)."""
        from cartwheel.sources import testdata as td
        return cls(users=td.users(spark, sf_dir), products=td.products(spark, sf_dir),
                   categories=td.categories(spark, sf_dir),
                   transactions=td.transactions(spark, sf_dir),
                   sessions=td.sessions(spark, sf_dir),
                   prices=td.product_prices(spark, sf_dir), puts=td.session_puts(spark, sf_dir))

    @classmethod
    def from_json(cls, spark: SparkSession, json_dir: str) -> "Shop":
        """The generator's JSON documents (one array per file), explicit schemas."""
        from cartwheel.sources import json_source as js
        return cls(**{name: js.read_dataset(spark, json_dir, name) for name in DATASETS})

    @classmethod
    def from_landed(cls, spark: SparkSession, path: str,
                    tables: dict[str, str] | None = None) -> "Shop":
        """Datasets written by :meth:`land`: by path, or through the bucketed
        table names it registered (which carry the bucketing to the planner)."""
        from cartwheel.sources import landing
        return cls(**{name: landing.read(spark, path, name, tables) for name in DATASETS},
                   **{name: landing.read_if_there(spark, path, name) for name in landing.DERIVED})

    def land(self, path: str, mode: str = "overwrite", bucketed: bool = False) -> "Shop":
        """Write all five datasets as Parquet and return a Shop reading them
        back (``bucketed=True``: user-keyed ones as tables bucketed by user_id;
        see ``sources.landing`` for the trade-off)."""
        from cartwheel.sources import landing
        spark = self.users.sparkSession
        tables = landing.write_all(self, path, mode=mode, bucketed=bucketed)
        return Shop.from_landed(spark, path, tables)

    def land_derived(self, path: str, mode: str = "overwrite") -> "Shop":
        """Store the flat timeline sorted by row key and the daily product metrics
        partitioned by month beside the landed datasets, and read all back."""
        from cartwheel.sources import landing
        landing.write_derived(self, path, mode)
        return Shop.from_landed(self.users.sparkSession, path)

    def cleaned(self) -> "Shop":
        """The same shop with transactions, sessions and products cleaned (Q1-Q3)."""
        from cartwheel.operators import clean
        return Shop(users=self.users, categories=self.categories,
                    products=clean.clean_products(self.products),
                    transactions=clean.clean_transactions(self.transactions),
                    sessions=clean.clean_sessions(self.sessions))

    def register_views(self, prefix: str = "", cleaned: bool = False) -> None:
        """Temp views ``users products categories transactions sessions`` so
        SQL text can be run with ``spark.sql``; ``cleaned=True`` registers the
        cleaned datasets under the same names, as a batch job's SQL expects."""
        shop = self.cleaned() if cleaned else self
        for name in DATASETS:
            getattr(shop, name).createOrReplaceTempView(prefix + name)
