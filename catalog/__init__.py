"""Registered queries: each operator applied to the given tables."""

from __future__ import annotations

from catalog.base import Query


def registered() -> dict[str, Query]:
    from catalog import fields, files, prepared, relational, search, texts

    out: dict[str, Query] = {}
    for module in (relational, fields, prepared, texts, search, files):
        out |= module.Q
    return out
