"""planmart: insurance-plan catalogue analytics on Spark DataFrames.

Subpackages: ``sources`` (landing, snapshots, catalog, CSV, JDBC),
``operators`` (rules, enrichment, marts, paging), ``functions`` (column
expressions), ``plans`` (reports, serving reads, dashboard panels, the daily
pipeline and the query registry) and ``streaming`` (empty: the workload is a
daily batch).
"""

__version__ = "0.1.0"
