"""playlab: class-imbalanced play-type classification on Spark.

Every public function takes and returns a DataFrame (or a fitted Spark ML
model) and keeps its work on the executors.  Sub-packages:

- ``sources``   reading the plays table, profiling it, writing reports
- ``functions`` column expressions shared by the operators (hashes, rules)
- ``operators`` cleaning, aggregates, sampling, SMOTE-NC, features, models,
                evaluation
- ``plans``     compositions (prepare / base frame / season test) and the
                query registry used by ``__spark_entry__``
- ``streaming`` the same row-level cleaning applied to a stream of plays
"""

__all__ = ["session"]
