"""strata: a Spark-native medallion warehouse (bronze CSV -> silver Parquet -> gold star schema).

Every operator takes and returns lazy DataFrames; only one-row statistics
(column null counts, date-format failure counts, a header line) ever reach
the driver.
"""

from strata.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
