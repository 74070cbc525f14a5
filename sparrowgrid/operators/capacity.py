"""Capacity arithmetic: named equations over a table of profiles, resolved by what each needs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What an equation may call, as SQL.
CALLS = {"ceil": "ceil", "max": "greatest", "min": "least"}
_TOKEN = re.compile(r"\s*(?:(?P<number>[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(?P<call>[a-z]+)(?=\s*\()|(?P<name>[A-Za-z_][A-Za-z0-9_]*)|(?P<sign>[-+*/(),]))")
#: Equations hold no power, no keyword and no value next to another.
_ODD = re.compile(r"\*\s*\*|/\s*/|\b(?:if|else|and|or|not|in|is|lambda|for)\b|[\w.)]\s+[\w(]")


def compiled(equation: str) -> tuple[str, set[str]]:
    """(SQL, names that it needs) of an equation; ValueError for anything but arithmetic. Numbers are doubles."""
    out, needs, at = [], set(), 0
    text = equation.strip()
    if _ODD.search(text) or not text:
        raise ValueError(f"not arithmetic: {text[:80]}")
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None or (m["call"] and m["call"] not in CALLS):
            raise ValueError(f"not arithmetic: {text[:80]}")
        at = m.end()
        if m["name"]:
            needs.add(m["name"])
        out.append(f"{float(m['number'])!r}D" if m["number"] else CALLS[m["call"]] if m["call"] else f"double(`{m['name']}`)" if m["name"] else m["sign"])
    return "double(" + " ".join(out) + ")", needs


def evaluate(profiles: DataFrame, equations: dict[str, str], common: dict[str, float]) -> DataFrame:
    """profiles with a column for each equation that its numeric columns, the common values and other equations determine."""
    sql = {name: compiled(text) for name, text in equations.items()}
    numeric = {c for c, t in profiles.dtypes if t in ("int", "bigint", "double", "float") or t.startswith("decimal")}
    out = profiles.withColumns({name: F.lit(float(v)) for name, v in common.items() if name not in profiles.columns}) if common else profiles
    known = numeric | set(common)
    while ready := {name: F.expr(text) for name, (text, needs) in sql.items() if name not in known and needs <= known}:
        out = out.withColumns(ready)
        known |= ready.keys()
    return out.drop(*[name for name in common if name not in profiles.columns])
