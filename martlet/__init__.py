"""martlet: build, clean, profile, cluster and enrich tabular data marts on Spark.

Everything here is a DataFrame / Spark SQL / MLlib composition; the heavy work
runs on executors and only bounded results (one profile row, k centres, bucket
counts) ever reach the driver.
"""

from martlet.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
