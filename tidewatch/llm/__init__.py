"""Training-data operators: formatting, packing, filtering, encoding and deduplication.

Nothing else in the library imports this subpackage; its queries are in ``queries``.
"""
