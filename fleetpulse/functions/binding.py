"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    Columns are inlined where they are used, so a long value used many times multiplies the
    generated code until it no longer compiles. Meant for rare branches and small tables:
    the body is interpreted rather than compiled.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_sql(value: Column, body: str) -> Column:
    """``let`` with its body as a SQL lambda: one parsed text instead of many client calls."""
    return F.get(F.call_function("transform", F.array(value), F.expr(body)), F.lit(0))
