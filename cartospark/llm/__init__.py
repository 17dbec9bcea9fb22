"""Operators for preparing large text collections as training data.

Nothing outside this subpackage imports it.  Each module holds one operator with its general
interface; :mod:`cartospark.llm.queries` holds the thin contract queries and their SQL.
"""
