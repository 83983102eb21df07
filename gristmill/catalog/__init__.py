"""Registered queries with their SQL counterparts, grouped by area."""

from gristmill.catalog import archives, corpus, documents, enrichment, manifests, words

AREAS = (documents, words, corpus, enrichment, archives, manifests)


def queries():
    return {name: fn for area in AREAS for name, fn in area.QUERIES.items()}


def oracle_sql():
    return {name: sql for area in AREAS for name, sql in area.SQL.items()}
