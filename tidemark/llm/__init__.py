"""Operators for training-data pipelines over text, pages and labels.

One module per operator; ``queries.py`` applies each to its whole table. Nothing else in the
library imports this package.
"""
