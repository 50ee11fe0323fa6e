"""Training-data operators: quality rules, deduplication, scoring, scans, extraction and mixing.

Nothing else in the library imports this subpackage.
"""
