"""Sources and sinks: driver-table fixtures, dated Parquet snapshots, catalog
tables, CSV landing and JDBC."""
