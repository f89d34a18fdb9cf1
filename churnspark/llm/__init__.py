"""Operators of a training-data pipeline, each a module of its own.

Nothing else in the library imports this subpackage; ``queries`` holds its
registered queries and ``oracles`` the DuckDB SQL for those SQL can express.
"""
