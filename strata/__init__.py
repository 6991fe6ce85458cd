"""strata: medallion lakehouse operators on the PySpark DataFrame API.

Layers: ``sources`` (schemas, files, fixtures), ``functions`` (column
expressions), ``operators`` (quality, dedup, CDC, SCD, incremental scope),
``plans`` (marts and the named query catalog) and ``streaming`` (thin
availableNow drivers with replay-safe publishing).
"""

__version__ = "0.1.0"
