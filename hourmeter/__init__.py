"""hourmeter: equipment-telemetry analytics as Spark DataFrame operators.

Layout
  functions/  Column expressions (normalisers, parsers, rounding) and fixed values
  sources/    readers: daily CSV drop folder, machine list, the test-table facade
  operators/  cleaning rules, run intervals, aggregates, rankings, reports
  plans/      the idempotent load, run logs, SQL views, dashboard document
  streaming/  file-stream ingest and replay
"""

from hourmeter.model import Tables

__all__ = ["Tables"]
