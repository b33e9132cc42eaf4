"""tallyspark: Spark-native analytics for sales, staff and data-quality workloads.

Every operator is a DataFrame transformation (or a small Spark job that returns a
DataFrame); Catalyst and adaptive execution pick the physical plan.
"""

from tallyspark.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
