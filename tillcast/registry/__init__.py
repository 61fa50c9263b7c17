"""The registered queries: every operator over the test tables, each with its SQL twin for another engine."""

from tillcast.registry import forecast, ledger, monitoring, tables, warehouse

_PARTS = (warehouse, forecast, monitoring, ledger, tables)


def queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
