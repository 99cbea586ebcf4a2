"""Compositions of operators: the nightly answer and the report products."""
