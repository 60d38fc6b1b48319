"""kestrel: PySpark-native data jobs.

Ingestion, parsing, nested SQL, missing-value statistics, imputation,
record-linkage scoring, reproducible sampling, text feature hashing,
classification and an implicit-feedback recommender with a per-user
AUC evaluator, all expressed as DataFrame / SQL / ``pyspark.ml`` work.
"""

__version__ = "0.1.0"
