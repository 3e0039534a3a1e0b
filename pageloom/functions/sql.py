"""Column helpers whose per-value part is SQL text.

A long expression over one value is written once as SQL and parsed by Spark in one
call. Binding the value to a lambda variable also means it is computed once, however
often the text names it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def each(array: Column, body: str) -> Column:
    """``body`` for every element ``x`` of an array."""
    return F.call_function("transform", array, F.expr(f"x -> {body}"))


def keep(array: Column, test: str) -> Column:
    """The elements ``x`` of an array that pass ``test``."""
    return F.call_function("filter", array, F.expr(f"x -> {test}"))


def bind(value: Column, body: str) -> Column:
    """``body`` for one value ``x``."""
    return F.get(each(F.array(value), body), F.lit(0))
