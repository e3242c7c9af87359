"""Training-data operators: tokenising, scans, joins, scoring and formatting of text corpora.

Nothing else in the library imports this subpackage.
"""
