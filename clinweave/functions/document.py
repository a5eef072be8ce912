"""Declared JSON documents.

A model states its document once, as nested `obj` and `arr` nodes over Columns. `render` turns it into
  * a typed struct ("omit": null members vanish when the struct is written as JSON), or
  * JSON text ("reference": null members stay as null, except those marked optional).
Both are plain Column expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Obj:
    members: dict[str, Any]
    # Member without which the object carries no information (omit mode drops the object).
    needs: str | None = None


@dataclass(frozen=True)
class Arr:
    items: tuple[Any, ...]


@dataclass(frozen=True)
class Opt:
    """Present only when `when` holds; without `when`, only when the value is not null."""

    value: Any
    when: Column | None = None


@dataclass(frozen=True)
class Rendered:
    """An array column whose elements were rendered before they were collected."""

    column: Column


def obj(members: dict[str, Any], needs: str | None = None) -> Obj:
    return Obj(members, needs)


def arr(*items: Any) -> Arr:
    return Arr(items)


def render(node: Any, nulls: str) -> Column:
    return _struct(node) if nulls == "omit" else _text(node)


def as_json(resource: Column | str, is_text: bool) -> Column:
    """The document as JSON text at the edge of the engine."""
    c = F.col(resource) if isinstance(resource, str) else resource
    return c if is_text else F.to_json(c)


# -- typed struct ---------------------------------------------------------------------------------


def _always(node: Any) -> bool:
    """Whether the rendered node can be seen, from its declaration alone, never to be null."""
    if isinstance(node, Obj):
        return node.needs is None and any(_always(m) for m in node.members.values())
    if isinstance(node, Arr):
        return all(_always(i) for i in node.items)
    return not isinstance(node, (Column, Opt, Rendered))


def _known(node: Any) -> Column | None:
    """When the node carries information, from its leaf columns; None = always."""
    if _always(node):
        return None
    if isinstance(node, Column):
        return node.isNotNull()
    if isinstance(node, Rendered):
        return node.column.isNotNull()
    if isinstance(node, Opt):
        inner = _known(node.value)
        if node.when is None or inner is None:
            return inner if node.when is None else node.when
        return node.when & inner
    if isinstance(node, Arr):
        parts = node.items
    else:
        parts = node.members.values() if node.needs is None else [node.members[node.needs]]
    tests = [_known(p) for p in parts]
    return None if any(c is None for c in tests) else reduce(or_, tests)


def _struct(node: Any) -> Column:
    """The node as a value, null where nothing is known of it."""
    value = _value(node)
    if isinstance(node, (Column, Rendered)):
        return value
    if isinstance(node, Opt):
        return value if node.when is None else F.when(node.when, value)
    known = _known(node)
    return value if known is None else F.when(known, value)


def _value(node: Any) -> Column:
    """The node without the test for being known."""
    if isinstance(node, Column):
        return node
    if isinstance(node, Rendered):
        return node.column
    if isinstance(node, Opt):
        return _struct(node.value)
    if isinstance(node, Arr):
        items = _same_members(node.items)
        if len(items) == 1:
            return F.array(_value(items[0]))
        listed = F.array(*[_struct(i) for i in items])
        return listed if all(_known(i) is None for i in items) else F.array_compact(listed)
    if isinstance(node, Obj):
        return F.struct(*[_struct(m).alias(name) for name, m in node.members.items()])
    return F.lit(node)


def _same_members(items: tuple[Any, ...]) -> list[Any]:
    """Objects of one array get the same member names, as an array has one element type."""
    if not all(isinstance(i, Obj) for i in items):
        return list(items)
    names = list(dict.fromkeys(name for i in items for name in i.members))
    absent = F.lit(None).cast("string")
    return [Obj({n: i.members.get(n, absent) for n in names}, i.needs) for i in items]


# -- JSON text ------------------------------------------------------------------------------------


def _scalar(c: Column) -> Column:
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _present(node: Opt) -> Column | None:
    if node.when is not None:
        return node.when
    return node.value.isNotNull() if isinstance(node.value, Column) else None


def _text(node: Any) -> Column:
    if isinstance(node, Column):
        return _scalar(node)
    if isinstance(node, Rendered):
        return F.coalesce(F.concat(F.lit("["), F.array_join(node.column, ","), F.lit("]")), F.lit("null"))
    if isinstance(node, Opt):
        cond = _present(node)
        value = _text(node.value)
        return value if cond is None else F.when(cond, value)
    if isinstance(node, Arr):
        return F.concat(F.lit("["), F.concat_ws(",", *[_text(i) for i in node.items]), F.lit("]"))
    if isinstance(node, Obj):
        members = [F.concat(F.lit(json.dumps(name) + ":"), _text(m)) for name, m in node.members.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return F.lit(json.dumps(node))
