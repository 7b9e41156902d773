"""Operators of a training-data pipeline, one module per operator.

``queries.QUERIES`` names the registered query of each operator (and
``pipeline``), ``queries.SQL`` the DuckDB SQL where one exists. Nothing
else in the library imports this subpackage.
"""
