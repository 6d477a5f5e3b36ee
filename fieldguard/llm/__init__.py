"""Training-data operators: extraction, tokenising, filtering, deduplication and mixing.

Nothing else in the library imports this subpackage.
"""
