"""Date rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_day(c: Column) -> Column:
    """Text or date to DATE; text that is no date becomes null."""
    return c.try_cast("date")


def month_start(c: Column) -> Column:
    """Grouping key of a calendar month: a DATE, so no text is built per row."""
    return F.trunc(c, "month")


def month_columns(first_day: Column) -> list[Column]:
    """annee, mois and the yyyy-MM label of a month key."""
    return [
        F.year(first_day).alias("annee"),
        F.month(first_day).alias("mois"),
        F.date_format(first_day, "yyyy-MM").alias("mois_label"),
    ]


def week_columns(day: Column) -> list[Column]:
    """Calendar year with ISO week: 2024-12-30 is (2024, 1)."""
    return [F.year(day).alias("annee"), F.weekofyear(day).alias("semaine")]
