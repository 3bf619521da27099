"""Regex triage of large source-code collections, written as PySpark DataFrame transformations."""

__version__ = "0.1.0"
