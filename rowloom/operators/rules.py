"""The quality-rule grammar: text rules and their dict form."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from rowloom.errors import RuleError


class _Shape(NamedTuple):
    severity: str
    values: tuple[str, ...] = ()
    takes_column: bool = True
    takes_options: bool = False
    exact: bool = False


# Rule names, parameter names and default severities.
_SHAPES = {
    "not_null": _Shape("block", exact=True),
    "unique": _Shape("block", exact=True),
    "min": _Shape("warn", ("min",)),
    "max": _Shape("warn", ("max",)),
    "range": _Shape("warn", ("min", "max")),
    "row_count": _Shape("block", takes_column=False, takes_options=True),
    "freshness": _Shape("warn", takes_options=True),
    "regex": _Shape("warn", ("pattern",)),
    "type_check": _Shape("warn", ("expected_type",)),
}

RULE_NAMES = tuple(_SHAPES)


def parse_quality_rule(rule: str | Mapping) -> dict:
    """Bring one quality rule into the form ``{column, rule, params, on_failure}``.

    Text rules read ``name(arguments)``; parameters stay text.  Surplus
    arguments of min, max, range and type_check are ignored; ``row_count`` may
    have no bounds.  The pattern of ``regex`` is everything after the first
    comma, so commas and inner spaces belong to it.  A dict rule is copied and
    gets the defaults of its rule name.  Malformed rules raise ``RuleError``,
    other kinds of object ``TypeError``.
    """
    if isinstance(rule, Mapping):
        return _complete(rule)
    if not isinstance(rule, str):
        raise TypeError(f"a quality rule is text or a dict, not {type(rule).__name__}")
    text = rule.strip()
    name, opened, rest = text.partition("(")
    name = name.strip()
    if not opened or not rest.endswith(")") or not re.fullmatch(r"\w+", name):
        raise RuleError(text, "expected name(arguments)")
    shape = _SHAPES.get(name)
    if shape is None:
        raise RuleError(text, f"unknown rule; use one of {', '.join(RULE_NAMES)}")
    body = rest[:-1].strip()
    # Only the first comma separates a pattern from its column.
    cuts = 1 if name == "regex" else -1
    arguments = [part.strip() for part in body.split(",", cuts)] if body else []

    column_name = ""
    if shape.takes_column:
        if not arguments or not arguments[0]:
            raise RuleError(text, "needs a column name")
        column_name = arguments.pop(0)
    if len(arguments) < len(shape.values) or (shape.exact and arguments):
        wanted = [*(["column"] if shape.takes_column else []), *shape.values]
        raise RuleError(text, f"needs {len(wanted)} argument(s): {', '.join(wanted)}")
    params = dict(zip(shape.values, arguments))
    if shape.takes_options:
        for argument in arguments:
            key, found, value = argument.partition("=")
            if not found:
                raise RuleError(text, f"expected key=value, found {argument!r}")
            params[key.strip()] = value.strip()
    return {
        "column": column_name,
        "rule": name,
        "params": params,
        "on_failure": shape.severity,
    }


def _complete(rule: Mapping) -> dict:
    name = rule.get("rule", "")
    shape = _SHAPES.get(name)
    if shape is None:
        raise RuleError(str(dict(rule)), f"unknown rule; use one of {', '.join(RULE_NAMES)}")
    column_name = rule.get("column") or ""
    params = dict(rule.get("params") or {})
    if shape.takes_column and not column_name:
        raise RuleError(str(dict(rule)), "needs a column name")
    for key in shape.values:
        if key not in params:
            raise RuleError(str(dict(rule)), f"needs the parameter {key!r}")
    return {
        **rule,
        "column": column_name,
        "rule": name,
        "params": params,
        "on_failure": rule.get("on_failure") or shape.severity,
    }


def parse_quality_rules(rules: Sequence[str | Mapping] | None) -> list[dict]:
    """Parse a list of quality rules; an empty list is a ``ValueError``."""
    if not rules:
        raise ValueError("a quality check needs at least one rule")
    return [parse_quality_rule(rule) for rule in rules]
