"""Operators for preparing large text corpora, built as Spark jobs.

Nothing outside this folder imports it; ``queries.py`` here lists the registered
queries and ``__spark_entry__.py`` adds them when the folder is present.
"""
