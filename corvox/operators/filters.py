"""The registers of the cleaning filters: functions on one text, and expressions over a column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

#: Name -> builder(options) -> (text column -> (new text, drop condition or None)), or a plain function.
COLUMN_FILTERS: dict[str, Callable[..., Callable[[Column], tuple[Column, Column | None]]]] = {}
TEXT_FILTERS: dict[str, Callable[..., Callable[[str], str | None]]] = {}


def column_filter(name: str) -> Callable:
    """Registers a filter that stays in the JVM."""

    def add(f: Callable) -> Callable:
        COLUMN_FILTERS[name] = f
        return f

    return add


def text_filter(name: str) -> Callable:
    """Registers a filter on one text; users add their own the same way."""

    def add(f: Callable) -> Callable:
        TEXT_FILTERS[name] = f
        return f

    return add
