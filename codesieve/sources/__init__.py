"""Inputs: pattern packs, source files, scanner events, search nodes, static-analysis results, tables."""
