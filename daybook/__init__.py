"""daybook: an activity warehouse on PySpark.

Landed service records -> normalised raw tables (quarantine for malformed records) ->
idempotent keyed upserts with per-entity cursors -> staging / intermediate / mart models ->
data-quality checks, in batch or Structured Streaming. All row work is DataFrame / SQL.
"""
