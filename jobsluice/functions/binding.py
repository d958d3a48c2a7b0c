"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` mentions it.

    Spark copies an expression into every place that refers to it when it merges
    projections or moves a filter down; a lambda variable is never copied.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
