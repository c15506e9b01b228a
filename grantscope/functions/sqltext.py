"""Spark SQL expression text for catalogue-driven expressions.

Large constant-driven expressions (score tables, rule metadata, detail
templates) are built once as SQL text and handed to Spark in one call
(``F.expr`` / ``selectExpr``), which keeps plan construction cheap; Catalyst
sees exactly the same expression tree either way.
"""

from __future__ import annotations

import re

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def lit(value) -> str:
    """A Spark SQL literal (strings escaped with backslashes, floats as doubles)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return repr(value) + "D"
    s = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def case_lookup(key: str, mapping: dict, default) -> str:
    """``mapping.get(key, default)`` as a CASE expression (NULL keys take the default)."""
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {key} {whens} ELSE {lit(default)} END)"


def template(text: str, fields: dict[str, str]) -> str:
    """``concat`` of a ``{name}`` template; NULL fields render as ``None`` like an f-string."""
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(text):
        if m.start() > pos:
            parts.append(lit(text[pos:m.start()]))
        parts.append(f"coalesce(cast({fields[m.group(1)]} AS STRING), 'None')")
        pos = m.end()
    if pos < len(text):
        parts.append(lit(text[pos:]))
    return "concat(" + ", ".join(parts) + ")"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"
