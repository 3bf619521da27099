"""Structured Streaming versions of the scan and of finding de-duplication."""
