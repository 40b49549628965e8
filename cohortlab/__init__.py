"""cohortlab: longitudinal cohort analytics as Spark DataFrame operators.

Sub-packages:
  sources    readers, typed loaders, text normalisers and sinks
  functions  column expressions (time, text, hashing)
  operators  cohort, text, sampling, feature and metric operators
  plans      model fitting, the study experiments and the query catalog
  llm        operators of a training-data pipeline (stands alone)
"""

__version__ = "0.1.0"
