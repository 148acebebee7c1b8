"""Queries over the given tables, each with its DuckDB counterpart where SQL can express it."""

from corpusmill.catalog import evaluation, feeding, filtering, records, synthetic, texts, tokens, uncut

MODULES = (texts, filtering, synthetic, feeding, tokens, records, uncut, evaluation)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
