"""Scans: page documents, tables and committed batches."""
