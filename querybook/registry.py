"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from querybook.standins import SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def _uses(text: str) -> list[str]:
    return [n for n in SQL if re.search(rf"\b{n}\b", text)]


def expand(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix `body` with the stand-in tables it names, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for inner in _uses(SQL[name]):
            if inner != name:
                visit(inner)
        ordered.append(name)

    for name in _uses(body):
        visit(name)
    body = body.strip()
    parts = [f"{n} AS ({SQL[n].strip()})" for n in ordered]
    recursive = "RECURSIVE " if re.search(r"\bRECURSIVE\b", body[:20]) else ""
    if recursive:
        body = re.sub(r"^WITH\s+RECURSIVE", "WITH", body)
    if body[:4].upper() == "WITH":
        rest = body[4:].strip()
        return f"WITH {recursive}" + ", ".join([*parts, rest])
    if not parts:
        return body
    return f"WITH {recursive}" + ", ".join(parts) + " " + body


def for_duckdb(text: str) -> str:
    for t in BASE_TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def oracles() -> dict[str, str]:
    """DuckDB text of every query that has one; expanded once all stand-ins are known."""
    return {name: for_duckdb(expand(sql)) for name, sql in ORACLES.items()}
