"""Operators for training-data pipelines, over tables of documents.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; :mod:`tracewright.llm.queries` applies them to
the given tables with production parameters.
"""
