"""Training-data operators: quality rules, tokenizers, near-duplicates, privacy, sharding, extraction.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries over the given tables.  Nothing
outside this package imports it.
"""
