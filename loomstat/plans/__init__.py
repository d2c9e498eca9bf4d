"""Named query catalogue: key -> (Spark query, DuckDB oracle SQL).

Each query is ``(spark, sf_dir) -> DataFrame`` over the test-data tables;
the oracle SQL reads the same parquet files as views of the same names.
Queries without an oracle are checked on row counts only.
"""

from loomstat.plans.registry import ORACLE, QUERIES  # noqa: F401
from loomstat.plans import core, stats_q, text_q, ml_q, more_q, model_q  # noqa: F401  (registers)
