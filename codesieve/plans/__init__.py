"""Compositions of operators: triage, static-analysis post-processing, export."""
