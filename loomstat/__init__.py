"""loomstat: Spark-native analytics toolkit.

Plain ``DataFrame -> DataFrame`` operators (``loomstat.operators``),
column expressions (``loomstat.functions``), readers and writers
(``loomstat.sources``), the named query catalogue (``loomstat.plans``)
and streaming entry points (``loomstat.streaming``).
"""

__version__ = "0.1.0"
