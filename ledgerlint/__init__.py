"""ledgerlint: cleaning and quality checks for customer-transaction tables on Spark.

Layout:
  functions/  column cleaners as Catalyst expressions (no Python UDFs)
  operators/  relational steps, the full-name rebuild and the quality reports
  sources/    raw CSV input, the test fixture and the target-table sinks
  plans/      the end-to-end cleaning plan
  streaming/  the same plan driven by a file stream (foreachBatch)
"""

from .plans.pipeline import Options, clean_all, clean_untyped, run_job

__all__ = ["Options", "clean_all", "clean_untyped", "run_job"]
