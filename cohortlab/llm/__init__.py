"""Operators of a training-data pipeline over document, vector and chat tables.

One module per operator; ``catalog`` binds each to its whole table as the
query ``opN_<name>``. Nothing else in the library imports this subpackage.
"""
