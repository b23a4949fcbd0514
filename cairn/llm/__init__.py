"""Training-data operators: dedup, scans, rules, tokens, packing, sharding.

Nothing else in the library imports this package; ``registry.queries()`` and
``registry.oracle_sql()`` hold its registered queries.
"""
