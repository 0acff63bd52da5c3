"""Registered queries over the test tables (see ``catalog``) and their DuckDB oracles (``oracle``)."""
