"""mailcase: Spark-native e-mail case triage.

Case exports are read, filtered, cleaned, labelled, split, profiled,
featurised, scored and evaluated as Spark DataFrame plans.
"""

__version__ = "0.1.0"
