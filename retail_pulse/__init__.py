"""Retail pulse: real-time retail analytics as plain Spark DataFrame functions.

Every operator is a ``DataFrame -> DataFrame`` function with column names as
parameters, so the same function serves a batch query over a table and the
body of a Structured Streaming ``foreachBatch``.
"""

from retail_pulse.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
