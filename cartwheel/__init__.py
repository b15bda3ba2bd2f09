"""cartwheel: e-commerce analytics on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame, built from
``pyspark.sql.functions``; no action runs inside an operator.
"""

from cartwheel.session import build_session, checkpoint_dir, configure
from cartwheel.sources.catalog import Shop

__all__ = ["Shop", "build_session", "checkpoint_dir", "configure"]
