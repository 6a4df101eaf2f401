"""State-change events and reference snapshots to analysis-ready tables, on PySpark.

Operators take and return DataFrames and stay lazy; sinks, streaming starters
and the job functions in ``plans.jobs`` are the only places that run actions.
"""

__version__ = "0.1.0"
