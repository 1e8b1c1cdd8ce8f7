"""Composed plans: the result registry and pipeline, the benchmark pipeline,
the registered queries and their SQL oracle."""
