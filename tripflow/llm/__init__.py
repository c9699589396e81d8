"""Training-data operators: dedup, scoring, extraction, mixing, encoding.

Nothing else in the library imports this subpackage; it imports only the
session helpers of ``tripflow``.
"""
