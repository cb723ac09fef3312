"""Operators for training-data pipelines, with their registered queries.

Nothing else in the library imports this subpackage. ``registry`` lists the
query modules; every operator module has a general function and the thin
``opN_<name>`` query that applies it to a whole table.
"""
