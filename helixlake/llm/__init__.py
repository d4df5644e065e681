"""Training-data operators: quality, deduplication, safety, packing, sharding and output.

Nothing outside this subpackage imports it.
"""
