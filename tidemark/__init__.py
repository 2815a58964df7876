"""tidemark: a daily dimensional warehouse built as Spark DataFrame jobs.

Layers (each a sub-package):

* ``sources``   – declared extract schemas, derived source extracts, the
                  landing zone (markers, completeness gate) and the raw layer
                  (idempotent partition replace, reconciliation).
* ``functions`` – small ``Column`` helpers (date keys, ISO weekday, look-back,
                  minute-boundary difference, surrogate keys, sentinels).
* ``operators`` – staging dedup, SCD2 history, dimensions, the point-in-time
                  join, the incremental fact, marts, data-quality checks and
                  reports. Pure ``DataFrame -> DataFrame`` unless named
                  ``write_*`` / ``*_day``.
* ``plans``     – the daily run and back-fill, plus the catalogue of
                  registered queries and their DuckDB oracle SQL.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
