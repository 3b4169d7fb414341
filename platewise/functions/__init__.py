"""Scalar column functions. Every one returns a native Spark ``Column``; there are no Python UDFs."""
