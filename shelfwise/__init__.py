"""shelfwise — daily catalogue price snapshots on Spark.

Subpackages:

* ``functions`` — column expressions (money, text, nested offers, calendar);
* ``operators`` — DataFrame → DataFrame operators (dedup, filters, merges, keys);
* ``sources``   — landing JSON reader, parquet tables and writers;
* ``plans``     — the snapshot build, the star schema, analytics, quality
  reports, batch control, and the registry of named queries;
* ``streaming`` — the file-stream face of the batch build.
"""

__version__ = "0.1.0"
