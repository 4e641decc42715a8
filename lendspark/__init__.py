"""lendspark — retail-lending lead intelligence as Spark DataFrame operators.

Every public operator takes and returns a :class:`pyspark.sql.DataFrame`.
Sub-packages:

* ``sources``    readers, writers and the driver-table adapters
* ``functions``  column-level helpers (clamps, safe division, formats, hashes)
* ``operators``  feature engineering, statistics, labels, models, metrics,
                 underwriting, explanations and portfolio queries
* ``plans``      end-to-end pipeline and the query catalog
* ``streaming``  micro-batch scoring of newly arriving customer rows
"""

__version__ = "0.1.0"
