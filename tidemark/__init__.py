"""Event-stream warehouse on Spark: facts, dimensions, history and metrics."""
