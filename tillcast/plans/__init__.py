"""Compositions (L1-L5), the end-to-end job, the named queries and their DuckDB oracles."""
