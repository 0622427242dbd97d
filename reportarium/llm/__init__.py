"""Operators for preparing training data: each module is one operator on DataFrames.

Modules take only the columns they name, so other columns of a table never clash with theirs.
"""
