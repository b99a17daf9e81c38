"""tillcast: retail demand analytics as Spark DataFrame jobs.

Layout
------
sources/    schemas, fixture adapter views, JDBC / CSV / Parquet readers and writers
functions/  column expressions (parsing, lookups, calendar, metrics)
operators/  DataFrame -> DataFrame steps (clean, daily, outliers, forecast, ml, quality)
plans/      compositions of operators (L1-L5) and the query / oracle registry
"""

from tillcast.session import get_session, checkpoint_dir, materialize  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "materialize"]
