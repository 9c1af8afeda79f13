"""Training-data operators: deduplication, filtering, search, packing and
token work over the ``documents`` and ``embeddings`` tables.

Each module holds one operator with its general interface;
``registry`` derives the registered ``opN_*`` queries from them.
"""
