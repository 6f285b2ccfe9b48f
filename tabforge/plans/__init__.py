from tabforge.plans.catalogue import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
