"""Training-data operators: sharding, deduplication, filtering, tokenisation.

Nothing outside this package imports it.  Each module holds one operator
with its own interface; :mod:`netloom.llm.queries` registers the thin
``opN_`` queries over the driver's tables.
"""
