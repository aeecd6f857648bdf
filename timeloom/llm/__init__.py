"""Operators for preparing training text at corpus scale.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame,
returns a DataFrame, keeps its model or statistics in tables of the shared
folder (``spark.checkpoint.dir``) and states its corner cases in its docstring.
"""
