"""wardmart: a Spark-native healthcare-finance warehouse.

Layers (each a set of lazy DataFrame operators):

* ``functions``  column expressions (id padding, sentinel casts, guarded
  ratios, three-valued flags, surrogate keys, calendar parts)
* ``sources``    typed CSV/Parquet scans, date spine, table sinks, audits
* ``operators``  relational building blocks (rename projections, latest /
  dominant row per key, size-checked lookup joins, scalable global rank and
  exact percentiles, margin roll-ups, data-quality checks, analyses)
* ``plans``      the warehouse models (staging, dims, facts, marts, the ETL
  forms, the declared data-test suite) and the query catalogue that runs
  them over the driver's TPC-H-style tables
"""

__all__ = ["functions", "sources", "operators", "plans"]
