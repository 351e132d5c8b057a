"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from workload import documents, guards, replication, reports, runs, tables

MODULES = (replication, documents, tables, guards, reports, runs)


def queries():
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
