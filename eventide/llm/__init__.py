"""Operators for preparing language-model training data.

Each module holds one operator with its general interface and the thin
``opN_<name>(spark, sf_dir)`` query that applies it to a whole table.
Nothing outside this package imports it.
"""
