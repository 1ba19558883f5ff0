"""Spark jobs that prepare, clean, score and report on question-to-SQL corpora."""

__version__ = "0.1.0"
