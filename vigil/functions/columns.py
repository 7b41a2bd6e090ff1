"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400

# Event types with their frequency windows in seconds, and the window of any other type.
TYPE_WINDOWS = {
    "login": 900,
    "payment": 600,
    "logout": 3600,
    "failed_login": 900,
    "password_reset": 7200,
    "other": 7200,
}
DEFAULT_TYPE_WINDOW = 3600


def unix_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a zone-less UTC timestamp, whatever the session time zone is."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    return days.cast("long") * DAY + F.hour(ts) * HOUR + F.minute(ts) * 60 + F.second(ts)


def minute(ts: str | Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def empty_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def first_rule(*rules: tuple[Column, str]) -> Column:
    """Name of the first rule that is broken, null when none is. A null condition counts as not broken."""
    chain = None
    for broken, name in rules:
        chain = F.when(broken, F.lit(name)) if chain is None else chain.when(broken, F.lit(name))
    return chain


def markov_threshold(total: Column, min_total: int = 20) -> Column:
    """Least probability a transition may have, by how many transitions were seen. Null: too few to tell."""
    return (
        F.when(total < min_total, F.lit(None).cast("double"))
        .when(total < 50, F.lit(0.02))
        .when(total > 200, F.lit(0.05))
        .otherwise(F.greatest(F.lit(0.01), 1.0 / F.sqrt(total.cast("double"))))
    )


def improbable(total: Column, count: Column, min_total: int = 20) -> Column:
    """True or false once there is data, null while there is too little."""
    return F.when(total >= min_total, count / total < markov_threshold(total, min_total))


def bucket_of(text: str | Column, buckets: int | Column) -> Column:
    """Repeatable bucket of a text: the first 32 bits of its MD5, modulo ``buckets``."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def has_offset(text: Column) -> Column:
    """Whether a moment names its distance from UTC."""
    return text.rlike(r"(?:[Zz]|[+-]\d{2}:?\d{2})$")
