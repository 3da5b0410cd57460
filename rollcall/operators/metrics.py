"""Counts of what a write has written, taken by the write itself instead of by reading its output again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from ..storage import settle


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are known when an action over all of it has ended."""
    watch = Observation()
    return df.observe(watch, *(c.alias(name) for name, c in metrics.items())), watch


def settle_with(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``df`` written and read back as by ``settle``, and the metrics of the rows written."""
    watched, watch = observed(df, metrics)
    done = settle(watched)
    return done, watch.get
