"""tidewatch: event-stream behaviour analytics written as Spark DataFrame plans.

Layout
------
sources    raw lines and test tables -> typed record frames (batch and stream)
functions  column expressions: epoch and display time, bitmap hash, messages
operators  windowed counts, top-N, sequence patterns, reconciliation, caps
plans      the fourteen jobs, their registered test-table forms and oracles
streaming  stream wiring, tagged and upsert sinks, stateful processors
"""

__version__ = "0.1.0"
