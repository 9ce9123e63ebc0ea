"""Metadata filter documents compiled to one Column.

Filters are two-valued: a comparison with a missing value is false and its
negation true. Negations are pushed down to the leaves and written as
``c <> v OR c IS NULL``, so that the scan can use every leaf.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, functions as F, types as T

# The accepted comparison operators and the negated ones.
_COMPARE = {
    "$eq": lambda c, v: c == v,
    "$gt": lambda c, v: c > v,
    "$lt": lambda c, v: c < v,
    "$gte": lambda c, v: c >= v,
    "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(v),
}
_NEGATED = {"$neq": "$eq", "$ne": "$eq", "$nin": "$in"}


def _fits(field: T.StructField, value: Any) -> bool:
    return isinstance(value, str) == isinstance(field.dataType, T.StringType)


def _leaf(field: T.StructField, op: str, value: Any, want: bool) -> Column:
    if op in _NEGATED:
        return _leaf(field, _NEGATED[op], value, not want)
    if op == "$not":
        return _field(field, value, not want)
    if op not in _COMPARE:
        raise ValueError(f"unknown filter operator: {op}")
    c = F.col(f"`{field.name}`")
    if value is None and op == "$eq":
        return c.isNull() if want else c.isNotNull()
    if op == "$in":
        value = [v for v in value if _fits(field, v)]
        if not value:
            return F.lit(not want)
    elif not _fits(field, value):
        if op == "$eq":
            return F.lit(not want)
        raise ValueError(f"{field.name} cannot be compared with {value!r}")
    test = _COMPARE[op](c, value)
    return test if want else ~test | c.isNull()


def _joined(parts: list[Column], all_of: bool, want: bool) -> Column:
    """AND or OR of parts; under a negation the two change places."""
    if not parts:
        return F.lit(all_of == want)
    return reduce(and_ if all_of == want else or_, parts)


def _field(field: T.StructField, cond: Any, want: bool) -> Column:
    if not isinstance(cond, dict):
        return _leaf(field, "$eq", cond, want)
    return _joined([_leaf(field, op, v, want) for op, v in cond.items()], True, want)


def _document(spec: dict, schema: T.StructType, want: bool) -> Column:
    parts = []
    for key, cond in spec.items():
        if key in ("$and", "$or"):
            parts.append(_joined([_document(s, schema, want) for s in cond], key == "$and", want))
        elif key == "$not":
            parts.append(_document(cond, schema, not want))
        elif key.startswith("$"):
            raise ValueError(f"unknown filter operator: {key}")
        elif key not in schema.names:
            raise ValueError(f"unknown filter field: {key}")
        else:
            parts.append(_field(schema[key], cond, want))
    return _joined(parts, True, want)


def compile_filter(spec: dict | None, schema: T.StructType) -> Column:
    """Filter document -> predicate for ``where``; an empty document keeps all rows."""
    return _document(spec or {}, schema, True)


def parse_filter(text: str | None) -> dict:
    """JSON text to a filter document; text that is no object filters nothing."""
    try:
        spec = json.loads(text or "")
    except ValueError:
        return {}
    return spec if isinstance(spec, dict) else {}
