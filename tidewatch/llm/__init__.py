"""Training-data operators: packing, scoring, encoding, deduplication, search.

Each module holds one operator by one method; ``queries`` registers them over
the driver's tables.  Nothing outside this package imports it.
"""
