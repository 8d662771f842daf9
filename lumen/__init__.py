"""lumen — analyst operators for PySpark.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark's own functions.  Sub-packages:

* ``sources``   — CSV / table ingest, catalog views, file inventory, saving
* ``functions`` — column expressions (calendar, safe ratios, categorical order)
* ``operators`` — aggregates, windows, time series, quality, chart preparation
* ``plans``     — the role tables built from the test data and the query registry
* ``streaming`` — incremental (Structured Streaming) forms of the ingest operators
"""

__version__ = "0.1.0"
