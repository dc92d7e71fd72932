"""Operators for large text corpora, each a Spark job over whole tables.

Nothing else in the package imports this subpackage.  ``queries`` registers
one query per operator and, where SQL can express the result, its statement.
"""
