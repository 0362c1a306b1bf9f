"""Registry of named queries and their DuckDB oracle SQL.

Each plan module registers ``(key, spark builder, oracle SQL or None)``. The
builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the SQL runs in
DuckDB on the same Parquet tables (pre-registered as views by the checker).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Decorator: register a query builder (and its oracle SQL when expressible)."""

    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        fn.query_key = key
        return fn

    return deco


def load_all() -> None:
    """Import every plan module (``q_*``) so their queries register."""
    import importlib
    import pkgutil

    import contentspark.plans as pkg

    for m in sorted(pkgutil.iter_modules(pkg.__path__), key=lambda m: m.name):
        if m.name.startswith("q_"):
            importlib.import_module(f"contentspark.plans.{m.name}")
