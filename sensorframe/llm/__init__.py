"""Training-data operators: scoring, deduplication, decontamination, mixing, sharding and chat formatting.

Nothing else in the library imports this subpackage.
"""
