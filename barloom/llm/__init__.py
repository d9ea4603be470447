"""Operators for preparing training data for language models.

Nothing outside this subpackage imports it; the registered queries are in
:mod:`barloom.llm.queries`.
"""
