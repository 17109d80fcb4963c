"""Transaction risk and compliance analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame, built from native
Spark expressions. ``riskspark.plans.pipeline.run`` does the whole batch.
"""

from riskspark.config import RiskConfig

__all__ = ["RiskConfig"]
