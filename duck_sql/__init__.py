"""DuckDB statements that state what each registered query must return on the sample tables."""

from __future__ import annotations

from duck_sql import augment, basket, generate, rfm, serving, warehouse


def all_sql() -> dict[str, str]:
    statements: dict[str, str] = {}
    for part in (warehouse, rfm, basket, serving, augment, generate):
        statements |= part.statements()
    return statements
