"""churnspark: Spark-native churn analytics.

Every operator takes DataFrames (plus plain Python configuration) and returns
DataFrames.  Fitted parameters are small DataFrames, never pickled objects.
"""

from churnspark.profile import Profile, TELCO

__all__ = ["Profile", "TELCO"]
__version__ = "0.1.0"
