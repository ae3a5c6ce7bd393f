"""tracewright: distributed-tracing span pipeline on PySpark.

Every operator is ``DataFrame -> DataFrame`` over the flat span table declared
in :mod:`tracewright.schema`. Span-local work is expressed as column
expressions (no shuffle); only whole-trace operators group on the numeric
trace key.
"""

from tracewright.schema import SPAN_SCHEMA  # noqa: F401

__all__ = ["SPAN_SCHEMA"]
