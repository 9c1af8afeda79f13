"""Composed plans: stand-in datasets, the reference's SQL statements, the
query registry used by ``__spark_entry__`` and end-to-end flows."""
