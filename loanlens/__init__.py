"""loanlens — credit-risk analytics as Spark DataFrame / SQL / ML / Streaming operators.

Every public operator takes DataFrames and returns DataFrames (or is a Spark ML
Estimator/Model).  Thresholds and rule parameters are arguments, never globals.
"""

__version__ = "0.1.0"
