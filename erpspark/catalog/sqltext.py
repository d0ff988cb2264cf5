"""Builds checking SQL from named subqueries and an output column list."""

from __future__ import annotations

import re

from erpspark.catalog.roles import ROLES, role_sql

_SQL_TYPES = {"l": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "t": "DATE", "b": "BOOLEAN"}

# r_<role> plus the named subqueries added by the oracle modules
PARTS: dict[str, str] = {f"r_{name}": role_sql(name) for name in [*ROLES, "dates"]}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def _needed(sql: str, found: list[str]) -> None:
    for word in re.findall(r"\b[rmk]_[a-z0-9_]+\b", sql):
        if word in PARTS and word not in found:
            _needed(PARTS[word], found)
            found.append(word)


def build(sql: str, spec: str) -> str:
    """Full statement: the needed subqueries, then the body cast to plain types."""
    names: list[str] = []
    _needed(sql, names)
    cols = ", ".join(
        f"CAST({c} AS {_SQL_TYPES[t]}) AS {c}" for c, t in (item.split(":") for item in spec.split())
    )
    ctes = [f"{n} AS ({PARTS[n]})" for n in names] + [f"final_rows AS ({sql})"]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {cols} FROM final_rows"


def r(x: str, digits: int) -> str:
    """Half-away-from-zero rounding through a decimal."""
    return f"round(cast({x} as decimal(38,8)), {digits})"


def div(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def pct(a: str, b: str, digits: int = 2) -> str:
    return r(f"{div(a, b)} * 100", digits)


def avg(x: str, scale: int = 4) -> str:
    return div(f"sum(cast({x} as decimal(28,{scale})))", f"count({x})")
