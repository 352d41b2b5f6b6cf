"""Queries over the provided tables, one per operator group, each with its SQL equivalent."""

from __future__ import annotations

from ledgertag.catalogue.registry import QUERIES, SQL, Query


def _load() -> None:
    from ledgertag.catalogue import evaluation, modelling, preparation  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
