"""bankflow: change-data-capture banking analytics on stock PySpark.

Layers, each a set of DataFrame-in / DataFrame-out functions:

* ``bankflow.sources``   change events, landing files, raw tables, fixtures
* ``bankflow.functions`` scalar column helpers (variant paths, money, text)
* ``bankflow.operators`` staging, SCD2 snapshots, marts, posting, data tests, KPIs
* ``bankflow.streaming`` Structured Streaming jobs for the same operators
* ``bankflow.plans``     run composition and the query registry
"""

from bankflow.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
