"""strata: an incremental lakehouse and governed metric layer on PySpark.

Every operator is a function from DataFrame(s) to DataFrame that composes
built-in Spark plans (joins, aggregates, windows, set operations); nothing is
collected to the driver and no UDF is used.
"""

from strata.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
