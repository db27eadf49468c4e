"""Training-data operators: filtering, deduplication, decontamination, token counts, mixing, sharding.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
general interface; ``queries`` holds the thin registered queries and their DuckDB SQL.
"""
