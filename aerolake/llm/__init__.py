"""Training-data operators: token files, fingerprints, near-duplicates, filters.

Nothing else in the package imports this one; its queries are in
``queries.py`` and their DuckDB SQL in ``oracle.py``.
"""
