"""Operators for preparing training data, one module per operator.

Nothing else in the library imports this package; ``queries`` registers one
query per operator and ``oracle`` holds the DuckDB SQL of those that SQL can
express."""
