"""civicflow: geolocated events and citizen reports on Spark.

* ``functions``  column expressions (checks, geometry, dates, report fields)
* ``operators``  validate, point-in-polygon grid join, keyed upsert, dedupe,
                 constraint checks, spreading few-split inputs
* ``sources``    scans (bronze CSV, JSON documents, clean Parquet) and the
                 inputs derived from the given tables
* ``sinks``      landing, partitioned writes, append, versioned snapshots
* ``plans``      jobs and analytical queries built from the above
* ``streaming``  incremental loads with file streams
* ``catalog``    the registered queries; ``oracle_sql`` their DuckDB oracles
"""
