"""Operators for preparing language-model training text with Spark.

Each module holds one operator with a general interface and, below it, the
thin query that ``queries.py`` registers.  Nothing outside this subpackage
imports it.
"""
