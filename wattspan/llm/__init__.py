"""Training-data operators: scoring, filtering, deduplication, tokenisation, packing, fingerprints.

One module per operator; `queries.py` binds each to its production parameters.
"""
