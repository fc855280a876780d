"""Registered queries: key -> (spark, sf_dir) -> DataFrame, plus DuckDB oracle SQL.

Each plan module registers its queries on import; ``catalog()`` imports them all.
"""
