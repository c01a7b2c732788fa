"""Scalar column functions. All are built-in expressions, so they stay in generated code."""
