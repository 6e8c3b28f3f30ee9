"""agrospark — agro-meteorological analytics as Spark DataFrame operators.

Layout
  functions/  Column-level expressions (season maps, ET0, crop coefficients, strict rolling)
  sources/    readers, JSON payload parsers, sinks, and the test-table adapters
  operators/  DataFrame -> DataFrame operators (clean, fill, windows, indices, rules, aggregates, reshape, ml)
  plans/      compositions (panel build, feature frames, scoring) and the query registry
  streaming/  Structured Streaming re-expressions of the batch pipelines
"""

from agrospark.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
