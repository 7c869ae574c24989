"""quire: Spark-native offline recommender analytics.

Entry points by concern (all take and return DataFrames; no global session):

* ``quire.sources``    - schemas, CSV / JSON / Parquet readers and writers, fixtures
* ``quire.functions``  - column expressions (hash buckets, casts, clamps, text)
* ``quire.operators``  - split, ranking, metrics, text, blend, models, profile
* ``quire.plans``      - evaluation job, materialised split, grid search, flagship
* ``quire.registry``   - one registered query per operator plus its SQL oracle
"""

__version__ = "0.1.0"
