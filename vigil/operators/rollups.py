"""Minute counts that are kept, so that a dashboard costs what it shows and not what happened.

Partial counts of any split of the rows add up to the counts of all of them: a micro-batch writes its own, and events that come
late are just more rows of an old minute. ``rolled_up`` writes the partial counts of many batches as one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import minute


def minute_partials(rows: DataFrame, column: str = "ts", by: Sequence[str] = ("event_type",)) -> DataFrame:
    """Rows per minute and values of ``by``."""
    return rows.groupBy(minute(column).alias("time"), *by).agg(F.count(F.lit(1)).alias("n"))


def added(partials: DataFrame, by: Sequence[str] = ("event_type",)) -> DataFrame:
    return partials.groupBy("time", *by).agg(F.sum("n").alias("n"))


def from_minutes(
    partials: DataFrame, counts: dict[str, Column | None], between: tuple[datetime, datetime] | None = None
) -> DataFrame:
    """A column per count: all rows, or those whose ``by`` values fulfil a condition. The range holds whole minutes, its end
    not included. Minutes without rows do not appear."""
    if between is not None:
        start, end = (F.lit(t).cast("timestamp_ntz") for t in between)
        partials = partials.where((F.col("time") >= start) & (F.col("time") < end))
    sums = {name: F.lit(True) if condition is None else F.coalesce(condition, F.lit(False)) for name, condition in counts.items()}
    return partials.groupBy("time").agg(*(F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name) for name, c in sums.items()))


def minutes_sink(store, table: str = "minutes", column: str = "ts", by: Sequence[str] = ("event_type",)) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the partial counts of each micro-batch once."""
    return store.sink(table, lambda batch: minute_partials(batch, column, by))


def rolled_up(store, table: str, target: str, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """The partial counts of all batches, added up and written by day as ``target``."""
    store.append(added(store.read(table), by), target, "time")
    return store.read(target)
