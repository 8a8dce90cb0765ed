"""Training-data operators: vector search, tokens, packing, archives, quality,
sharding and duplicate removal over whole text tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries.py`` registers one query per operator.
"""
