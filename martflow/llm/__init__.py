"""Training-data operators: scans, near-duplicate search, scoring, tokenizing.

Each module holds one operator with its own general interface;
``queries`` registers the thin ``opN_*`` query of each.
"""
