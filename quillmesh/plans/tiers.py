"""Views over a catalogue of books by classification, size and age, and the queue of what to read next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.sets import queue


def tier_views(books: DataFrame, rules: dict[str, Column], columns: list[str]) -> dict[str, DataFrame]:
    """A view per rule; rules are predicates over the joined catalogue."""
    return {name: books.filter(rule).select(*columns) for name, rule in rules.items()}


def register(views: dict[str, DataFrame], prefix: str = "") -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def reading_queue(views: dict[str, DataFrame], tiers: dict[str, int], key: str, *, highest_only: bool = False) -> DataFrame:
    """Books of all views: once per reason, or once with the highest tier."""
    return queue([(name, tiers[name], df) for name, df in views.items()], key, highest_only=highest_only)
