"""Training-data operators: sharding, extraction, tokenisation, packing, deduplication, scoring.

Nothing else in the library imports this subpackage. Each module is one operator; ``queries``
registers them for the driver and ``oracle`` holds their DuckDB SQL.
"""
