"""Transaction-risk and entity-graph analytics as PySpark DataFrame operators."""
