"""The full query registry (keys follow SURVEY section 7.6)."""

from __future__ import annotations

from bowline.plans import io_queries, lr_queries, nb_queries


def all_queries() -> dict:
    return nb_queries.QUERIES | lr_queries.QUERIES | io_queries.QUERIES


def all_oracles() -> dict:
    return nb_queries.ORACLE | lr_queries.ORACLE | io_queries.ORACLE
