"""copub: co-authorship analytics as Spark DataFrame plans.

Layout
------
- ``copub.sources``   readers and writers (JSON exports, papers CSV, topic ids,
                      graph and ego tables in Parquet)
- ``copub.functions`` column expressions and the period list
- ``copub.operators`` papers, flags, co-author graph, ego counts, period metrics
- ``copub.plans``     the test-data fixtures and the registered query catalog
- ``copub.streaming`` incremental ego counts over arriving export files

Every operator is a function ``DataFrame -> DataFrame``; nothing is collected
to the driver and no Python UDF is used.
"""

__version__ = "0.1.0"
