"""Operators of a training-data pipeline: each module is one operator, `queries` registers them."""
