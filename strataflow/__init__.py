"""strataflow: a layered raw -> core -> mart warehouse on Spark DataFrames.

Every function takes DataFrames and returns DataFrames, and every clock value
(`now`, `as_of`) is a parameter, so a rerun gives the same rows.
"""

from strataflow.session import get_spark, run_dir, shared_dir

__all__ = ["get_spark", "run_dir", "shared_dir"]
