"""hackney: taxi trip and fare analytics on Spark.

Raw trip and fare lines become typed records, trips and fares are
correlated per key, pickups are counted per grid cell in hopping windows,
and driver payments are summed in tumbling windows.  Every operator is a
``DataFrame -> DataFrame`` function built from native column expressions,
so the same code serves batch tables and Structured Streaming.
"""

from hackney.session import checkpoint_dir, get_session

__all__ = ["checkpoint_dir", "get_session"]
