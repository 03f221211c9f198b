"""Training-data operators: dedup, packing, audits, classifiers, scans, search and token counts.

Nothing outside this subpackage imports it.
"""
