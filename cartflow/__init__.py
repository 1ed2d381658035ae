"""cartflow: storefront session analytics on Spark.

User events become one record per session (views, searches, cart value,
checkout, purchase, abandonment).  On top of those records sit funnels,
abandonment and persona reports, risk scoring, outcome labelling,
user/product/category roll-ups and Spark ML training.  Every operator is a
function from DataFrames to DataFrames.
"""

from cartflow.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
